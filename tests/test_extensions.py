"""Design-note statistics, the calendar, kept rows and classifiers on hand-made and real texts."""

import csv
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from courtside.functions import buckets
from courtside.functions.classify import GENERAL_STATS, flag, general_predicates
from courtside.plans import dims
from courtside.plans import extensions as X
from courtside.plans.plays import derived_metrics, game_player_measures, participants, play_flags, play_stream, player_game_stats
from courtside.sources.adapter import Sources

SLOTS = ", ".join(f"player{i}_name string, player{i}_team_city string, player{i}_team_nickname string" for i in (1, 2, 3))
PLAYS = f"game_id long, eventnum long, {SLOTS}, homedescription string, visitordescription string"


def _play(event, text, *names, away=None):
    cells = [c for n, team in names for c in (n, *team)] + [None] * (9 - 3 * len(names))
    return (1, event, *cells, text, away)


A, B = ("Boston", "Celtics"), ("Phoenix", "Suns")


def test_team_points_go_to_the_first_players_team_once(spark):
    plays = spark.createDataFrame([
        _play(1, "Bird 26' 3PT Jump Shot (3 PTS) (Ainge 1 AST)", ("Bird", A), ("Ainge", A)),
        _play(2, "MISS Bird Layup", ("Bird", A), (None, B), ("Nash", B), away="Nash BLOCK (1 BLK)"),
        _play(3, None, ("Nash", B), away="Nash Free Throw 1 of 2 (1 PTS)"),
        _play(4, "Celtics Timeout", ("", A))], PLAYS)
    got = {r["equipo"]: (r["jugadas"], r["puntos"], r["tiros_fallidos"]) for r in X.team_game(plays).collect()}
    # the block's text of play 2 also belongs to a play that a Boston player starts
    assert got == {"Boston Celtics": (3, 3, 1), "Phoenix Suns": (1, 1, 0)}


def test_running_score_orders_text_event_numbers_as_numbers(spark):
    rows = [_play(i, "Bird 3PT Jump Shot", ("Bird", A)) for i in range(1, 13)]
    plays = spark.createDataFrame(rows, PLAYS).withColumn("eventnum", F.col("eventnum").cast("string"))
    got = {r["eventnum"]: r["marcador_local"] for r in X.running_score(plays).collect()}
    assert got == {i: 3 * i for i in range(1, 13)}


def test_failed_steals_follow_a_miss(spark):
    plays = spark.createDataFrame([_play(1, "MISS Bird Layup Nash STEAL (1 STL)", ("Bird", A), ("Nash", B)),
                                   _play(2, "Bird Bad Pass Turnover", ("Bird", A))], PLAYS)
    got = {r["jugador"]: r["Robos_Fallidos"] for r in X.extra_fouls(plays).collect()}
    assert got == {"bird": 1, "nash": 1}


def test_no_measure_is_constant_on_the_driver_tables(spark, sf_small):
    plays = Sources(spark, sf_small.replace("sf0.001", "sf0.01")).plays
    for df in (game_player_measures(plays), X.extra_fouls(plays), X.rebound_split(plays), X.team_game(plays)):
        names = [c for c, t in df.dtypes if t in ("int", "bigint", "double") and c != "game_id"]
        spread = df.agg(*[F.countDistinct(c) for c in names]).first()
        assert all(n > 1 for n in spread), dict(zip(names, spread))


def test_calendar_ids_never_change(spark):
    fixed = dims.calendar_dim(spark)
    games = spark.createDataFrame([("2024-01-02 00:00:00",), ("1945-12-30 00:00:00",), ("9999-12-31 00:00:00",), ("x",)],
                                  "game_date string")
    wide = dims.calendar_dim(spark, games=games)
    assert fixed.exceptAll(wide).count() == 0
    more = sorted(tuple(r) for r in wide.exceptAll(fixed).collect())
    assert [(r[0], r[4], r[3], r[2]) for r in more] == [
        (-1, 1945, 12, 30), (0, 1945, 12, 31), (28490, 2024, 1, 1), (28491, 2024, 1, 2)]
    assert dims.calendar_dim(spark, games=games.where("game_date = 'x'")).count() == 28489


def test_fullest_row_survives(spark):
    officials = spark.createDataFrame([(1, None, None), (1, "", "Crawford"), (1, "Joey", "Crawford")],
                                      "official_id int, first_name string, last_name string")
    assert [r["nombre"] for r in dims.referee_dim(officials).collect()] == ["Joey Crawford"]


def test_options_change_only_what_they_name(spark):
    plays = spark.createDataFrame([_play(1, "Carroll 3PT Jump Shot (Price 1 AST)", ("Carroll", A), ("Price", A)),
                                   _play(2, "Carroll REBOUND (Off:1 Def:0)", ("Carroll", A))], PLAYS)
    parts = participants(play_stream(plays))

    def points(**options):
        return {r["jugador"]: r["Puntos_Totales"] for r in derived_metrics(player_game_stats(play_flags(parts, **options))).collect()}

    assert points() == {"carroll": 5, "price": 3}  # 'roll' in the name counts as a made two
    assert points(whole_words=True) == {"carroll": 3, "price": 3}
    assert points(attribution="primary") == {"carroll": 5, "price": 0}
    gap = spark.createDataFrame([(1.8923,), (1.79,), (2.2,), (0.0,), (None,)], "x double")
    got = [r[0] for r in gap.select(buckets.bucketize("x", buckets.HEIGHT_M, half_open=True)).collect()]
    assert got == ["Bajo", "Muy bajo", "Muy alto", "Desconocido", "Desconocido"]
    names = spark.createDataFrame([("Mark ",), ("mark",), ("Ann",)], "nombre string")
    assert [tuple(r) for r in dims.ambiguous_names(names, names.limit(1)).collect()] == [("jugador", "mark", 2)]


# How many of the 114 play texts each classifier fits.
COUNTS = {"Tiros_Dobles_Exitosos": 10, "Tiros_Dobles_Fallidos": 10, "Tiros_Triples_Exitosos": 6, "Tiros_Triples_Fallidos": 7,
          "Tiros_Libres_Exitosos": 4, "Tiros_Libres_Fallidos": 4, "Rebotes_Obtenidos": 1, "Rebotes_Defensivos_Obtenidos": 0,
          "Rebotes_Ofensivos_Obtenidos": 0, "Perdidas_Balon": 35, "Cambios_Jugadores": 1, "Tiempos_Muertos": 2,
          "Faltas_Personales": 2, "Faltas_Balon_Suelto": 0, "Faltas_Disparo": 1, "Faltas_Rebote": 2, "Faltas_Ofensivas": 2,
          "Cantidad_Ataques_Fallidos_General": 22, "Numero_Jugadas_Totales": 114}


def test_classifiers_on_real_play_texts(spark):
    with open(os.path.join(os.path.dirname(__file__), "golden", "play_texts.csv"), newline="", encoding="utf-8") as f:
        texts = [(r["descripcion"],) for r in csv.DictReader(f)]
    d = F.lower("descripcion")
    got = spark.createDataFrame(texts, "descripcion string").agg(
        *[F.sum(flag(p)).alias(n) for n, p in general_predicates(d).items()],
        *[F.count_if(d.contains(x)).alias(x) for x in ("jump ball", "block", "steal")]).first().asDict()
    assert list(COUNTS) == GENERAL_STATS
    assert got == COUNTS | {"jump ball": 5, "block": 4, "steal": 1}


def test_rebounds_are_labelled_by_the_counter_that_rose(spark):
    texts = [(1, "A REBOUND (Off:0 Def:1)"), (2, "A REBOUND (Off:1 Def:1)"), (3, "B REBOUND (Off:0 Def:1)"), (2000, "A REBOUND (Off:1 Def:2)"),
             (2001, "A REBOUND"), (2002, "A REBOUND (Off:2 Def:3)"), (2003, "A REBOUND (Off:3 Def:3)")]
    rows = [(7, n, t[0], None, None, t, None) for n, t in texts]
    plays = spark.createDataFrame(rows, "game_id long, eventnum int, player1_name string, player2_name string, player3_name string, "
                                        "homedescription string, visitordescription string")
    got = {r.eventnum: r.tipo for r in X.rebound_events(plays).collect()}
    assert got == {1: "defensivo", 2: "ofensivo", 3: "defensivo", 2000: "defensivo", 2001: "sin_clase", 2002: "sin_clase", 2003: "ofensivo"}


def test_previous_values_cross_chunks(spark):
    df = spark.range(0, 900).where("id % 100 < 60").selectExpr("CASE WHEN id % 7 = 0 THEN NULL ELSE id % 3 END AS g", "id AS o", "CASE WHEN id % 5 > 0 THEN id END AS v")
    got = X.previous_values(df, ["g"], "o", ["v"], chunk=16)
    want = df.select("g", "o", "v", F.lag("v").over(Window.partitionBy("g").orderBy("o")).alias("prev_v"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_shared_names_count_once(spark):
    """Two players of one name: each game's row goes to the one of the roster's team; no point is doubled."""
    from courtside.plans.fact import resolved_measures

    schema = "game_id long, eventnum int, " + ", ".join(f"player{i}_{c} string" for i in (1, 2, 3) for c in ("name", "team_city", "team_nickname")) + \
             ", homedescription string, visitordescription string"
    none = (None,) * 6
    rows = [(1, 1, "Jo Doe", "Rome", "Reds", *none, "Jo Doe 3PT shot", None), (2, 1, "JO DOE ", "Oslo", "Owls", *none, "Jo Doe layup", None),
            (3, 1, "jo doe", "Bern", "Bees", *none, "Jo Doe layup", None), (1, 2, "Al Low", None, None, *none, "free throw", None)]
    player = spark.createDataFrame([(1, "Jo Doe", "Rome Reds"), (2, "Jo Doe", "Oslo Owls"), (3, "Al Low", ""), (4, None, "Rome Reds")], "idJugador long, nombre string, equipo string")
    got = {(r.game_id, r.jugador): (r.idJugador, r.candidatos, r.Puntos_Totales) for r in resolved_measures(spark.createDataFrame(rows, schema), player).collect()}
    assert got == {(1, "jo doe"): (1, 2, 3), (2, "jo doe"): (2, 2, 2), (3, "jo doe"): (1, 2, 2), (1, "al low"): (3, 1, 1)}
