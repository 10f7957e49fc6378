"""Play classifiers and the per player-game measures on hand-made plays."""

from pyspark.sql import functions as F

from courtside.functions.classify import flag, general_predicates
from courtside.plans import plays as P

# Descriptions of the kind found in play-by-play exports (lower-cased by the stream).
TEXTS = {
    "Mercer BLOCK (1 BLK)": {},
    "Jump Ball Kanter vs. Mark Morris: Tip to Frye": {},
    "MISS Jordan 3' Layup BLOCK (1 BLK)": {"Tiros_Dobles_Fallidos": 1, "Cantidad_Ataques_Fallidos_General": 1},
    "Thomas REBOUND (Off:1 Def:0)": {"Rebotes_Obtenidos": 1},
    "SUB: Arna FOR Bogdanovic": {"Cambios_Jugadores": 1},
    "Curry Offensive Foul Turnover (P1.T1)": {"Faltas_Rebote": 1, "Faltas_Ofensivas": 1},
    "McCarty S.FOUL (P1.PN)": {"Faltas_Disparo": 1},
    "Stojakovic 24' 3PT Fadeaway Jumper (10 PTS)": {"Tiros_Triples_Exitosos": 1},
    "Carroll REBOUND (Off:0 Def:1)": {"Rebotes_Obtenidos": 1, "Tiros_Dobles_Exitosos": 1},  # 'roll' inside a name
    "Smith Free Throw 1 of 2 (3 PTS)": {"Tiros_Libres_Exitosos": 1},
    "MISS Smith Free Throw 2 of 2": {"Tiros_Libres_Fallidos": 1, "Cantidad_Ataques_Fallidos_General": 1},
    "Nets Timeout: Regular (Full 1 Short 0)": {"Tiempos_Muertos": 1},
    "Jones Bad Pass Turnover (P2.T4)": {"Perdidas_Balon": 1},
    "Brown P.FOUL (P2.PN)": {"Faltas_Personales": 1},
    "Green L.B.FOUL (P1.PN)": {"Faltas_Balon_Suelto": 1},
}


def test_general_predicates_match_expected(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").select(
        "t", F.lower("t").alias("d"))
    preds = general_predicates(F.col("d"))
    rows = df.select("t", *[flag(p).alias(n) for n, p in preds.items()]).collect()
    for r in rows:
        want = TEXTS[r["t"]]
        for name in preds:
            if name == "Numero_Jugadas_Totales":
                assert r[name] == 1
            else:
                assert r[name] == want.get(name, 0), (r["t"], name)


def _plays(spark, rows):
    cols = ("game_id bigint, eventnum int, player1_name string, player2_name string, player3_name string, "
            "homedescription string, visitordescription string")
    return spark.createDataFrame(rows, cols)


def test_slot_statistics_and_derived(spark):
    plays = _plays(spark, [
        (1, 1, "A", "B", "C", "Jump Ball A vs. B: Tip to C", None),
        (1, 2, "A", None, "C", None, "MISS A 5' Dunk C BLOCK (1 BLK)"),
        (1, 3, " a ", "B", None, "B STEAL (1 STL)", None),
        (1, 4, "A", "A", None, "A 24' 3PT Jump Shot (3 PTS) (A 1 AST)", None),   # one player in two slots
        (1, 5, "", None, None, "Layup", None),                                    # empty name: no general stats
        (2, 1, "A", None, None, None, None),                                      # no text: no play
    ])
    m = {(r["game_id"], r["jugador"]): r for r in P.game_player_measures(plays).collect()}
    a, b, c = m[(1, "a")], m[(1, "b")], m[(1, "c")]
    assert (a["Saques_Exitosos"], b["Saques_Fallidos"], c["Saques_Exitosos"]) == (1, 1, 1)
    assert c["Tiros_Bloqueados"] == 1 and a["Tiros_Bloqueados"] == 0
    assert b["Robos_Exitosos"] == 1 and a["Robos_Exitosos"] == 0
    # duplicate slot counts twice: 2 triples -> 6 points
    assert a["Tiros_Triples_Exitosos"] == 2 and a["Puntos_Totales"] == 6
    assert a["Numero_Jugadas_Totales"] == 5
    assert a["Cantidad_Ataques_Exitosos"] == 3 and a["Proporcion_Exito_Ataques"] == 0.6
    assert b["Cantidad_Ataques_Fallidos"] == 1
    assert (1, "") not in m and (2, "a") not in m


def test_one_pass_equals_outer_merge(spark, sf_small):
    from courtside.plans.fact import stats_outer_merge
    from courtside.plans.warehouse import Warehouse

    wh = Warehouse(spark, sf_small)
    plays = wh.src("plays")
    names = wh.player.select("idJugador", F.lower(F.trim("nombre")).alias("jugador"))
    one = P.game_player_measures(plays).join(names, "jugador").drop("jugador")
    merged = stats_outer_merge(plays, wh.player)
    cols = sorted(one.columns)
    assert sorted(merged.columns) == cols
    assert one.select(cols).exceptAll(merged.select(cols)).count() == 0
    assert merged.select(cols).exceptAll(one.select(cols)).count() == 0
