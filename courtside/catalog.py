"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Names are the operator IDs' query names of the blueprint; each has a
DuckDB counterpart in ``courtside.checks.oracle.ORACLE`` unless it is
documented as rows-only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions import buckets as B

from courtside.plans import fact as fact_plan
from courtside.plans import plays as P
from courtside.plans.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, sf_dir)


def q_play_stream(spark, sf_dir):
    return P.play_stream(_wh(spark, sf_dir).src("plays"))


def q_participants(spark, sf_dir):
    return P.participants(P.play_stream(_wh(spark, sf_dir).src("plays")))


def q_play_flags(spark, sf_dir):
    return P.play_flags(P.participants(P.play_stream(_wh(spark, sf_dir).src("plays"))))


def q_player_game_stats(spark, sf_dir):
    return P.player_game_stats(q_play_flags(spark, sf_dir))


def q_derived_metrics(spark, sf_dir):
    return P.game_player_measures(_wh(spark, sf_dir).src("plays"))


def q_referee_dim(spark, sf_dir):
    return _wh(spark, sf_dir).referee


def q_league_dim(spark, sf_dir):
    return _wh(spark, sf_dir).league


def q_calendar_dim(spark, sf_dir):
    return _wh(spark, sf_dir).calendar


def q_venue_dim(spark, sf_dir):
    return _wh(spark, sf_dir).venue


def q_team_dim(spark, sf_dir):
    return _wh(spark, sf_dir).team


def q_player_dim(spark, sf_dir):
    return _wh(spark, sf_dir).player


def q_game_header(spark, sf_dir):
    return _wh(spark, sf_dir).header


def q_fact_partido(spark, sf_dir):
    return _wh(spark, sf_dir).partido


QUERIES: dict[str, Query] = {
    "play_stream": q_play_stream,
    "participants": q_participants,
    "play_flags": q_play_flags,
    "player_game_stats": q_player_game_stats,
    "derived_metrics": q_derived_metrics,
    "referee_dim": q_referee_dim,
    "league_dim": q_league_dim,
    "calendar_dim": q_calendar_dim,
    "venue_dim": q_venue_dim,
    "team_dim": q_team_dim,
    "player_dim": q_player_dim,
    "game_header": q_game_header,
    "fact_partido": q_fact_partido,
}


# -- sources and sinks ----------------------------------------------------------

def q_csv_roundtrip(spark, sf_dir):
    """S1/S2/S7: customers written as CSV by Spark, read back as text, pruned."""
    from courtside.operators.materialize import scratch_path
    from courtside.sources.files import read_csv_text, write_csv

    cust = _wh(spark, sf_dir).src("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    path = scratch_path(cust, "csv")
    write_csv(cust, path)
    return read_csv_text(spark, path, ["c_custkey", "c_name", "c_mktsegment"])


def q_table_roundtrip(spark, sf_dir):
    """S3/S5/S6/S8/S9: contract tables created, overwritten by position, replaced, read back."""
    import uuid

    from courtside.operators.materialize import scratch_path
    from courtside.sources.files import create_contract_tables, drop_table, insert_overwrite, read_contract, \
        replace_table

    wh = _wh(spark, sf_dir)
    db = f"courtside_{uuid.uuid4().hex[:12]}"
    loc = scratch_path(wh.src("orders"), "warehouse")
    create_contract_tables(spark, db, loc, ["arbitro", "liga"])
    insert_overwrite(wh.referee, f"{db}.arbitro")
    drop_table(spark, f"{db}.liga")
    replace_table(wh.league, f"{db}.liga")
    ref = read_contract(spark, f"{db}.arbitro", ["idArbitro", "nombre"])
    liga = read_contract(spark, f"{db}.liga", ["idLiga", "nombre"])
    return ref.select(F.lit("arbitro").alias("tabla"), F.col("idArbitro").alias("id"), "nombre").unionByName(
        liga.select(F.lit("liga").alias("tabla"), F.col("idLiga").alias("id"), "nombre"))


# -- dimension pieces -----------------------------------------------------------

def q_unit_convert(spark, sf_dir):
    from courtside.plans.dims import unit_conversions

    wh = _wh(spark, sf_dir)
    u = unit_conversions(wh.src("player_profile"), wh.src("draft_combine"))
    return u


def _bucket_query(value: str, rules, out: str):
    def q(spark, sf_dir):
        from courtside.functions.buckets import bucketize
        from courtside.plans.dims import unit_conversions

        wh = _wh(spark, sf_dir)
        u = unit_conversions(wh.src("player_profile"), wh.src("draft_combine"))
        return u.select("player_id", bucketize(value, rules).alias(out))

    q.__name__ = f"q_bucket_{out}"
    return q


def q_position_map(spark, sf_dir):
    from courtside.functions.buckets import position_label

    p = _wh(spark, sf_dir).src("player_profile")
    return p.select(F.col("person_id").alias("player_id"), "position", position_label("position").alias("posicion"))


def q_capacity_bucket(spark, sf_dir):
    from courtside.functions.buckets import capacity_bucket
    from courtside.functions.text import to_number

    wh = _wh(spark, sf_dir)
    d = wh.src("team_details").select("arena", F.col("arenacapacity").alias("capacidad_numero"))
    m = wh.src("team_list").select(F.col("Arena").alias("arena"), F.col("Capacidad").alias("capacidad_numero"))
    both = d.unionByName(m)
    return both.select("arena", "capacidad_numero", capacity_bucket(to_number("capacidad_numero")).alias("capacidad"))


# -- fact pieces ------------------------------------------------------------------

def q_roster(spark, sf_dir):
    return fact_plan.roster(_wh(spark, sf_dir).src("plays"))


def q_roster_measures(spark, sf_dir):
    return fact_plan.roster_measures(_wh(spark, sf_dir).src("plays"))


def q_date_key(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return fact_plan.date_key(wh.src("games"), wh.calendar)


def q_venue_key(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return fact_plan.home_team_venue(wh.src("games"), wh.team, wh.venue)


def q_season_alias_join(spark, sf_dir):
    """Q2: league key with the alias folded on the dimension side only (source
    behaviour) and on both sides (default)."""
    from courtside.functions.text import season_type
    from courtside.operators.lookup import lookup

    wh = _wh(spark, sf_dir)
    g = wh.src("games").select("game_id", "season_type", season_type("season_type").alias("liga"))
    g = lookup(g, wh.league, ["season_type"], ["nombre"], ["idLiga"], rename={"idLiga": "idLiga_origen"})
    g = lookup(g, wh.league, ["liga"], ["nombre"], ["idLiga"])
    return g.select("game_id", "season_type", "idLiga_origen", "idLiga")


def q_jump_balls(spark, sf_dir):
    return P.jump_balls(P.play_stream(_wh(spark, sf_dir).src("plays")))


def q_blocks(spark, sf_dir):
    return P.blocks(P.play_stream(_wh(spark, sf_dir).src("plays")))


def q_steals(spark, sf_dir):
    return P.steals(P.play_stream(_wh(spark, sf_dir).src("plays")))


def q_stats_outer_merge(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return fact_plan.stats_outer_merge(wh.src("plays"), wh.player)


# -- vocabularies ---------------------------------------------------------------------

def q_name_vocabulary(spark, sf_dir):
    from courtside.plans.vocab import name_vocabulary

    return name_vocabulary(_wh(spark, sf_dir).src("games"))


def q_position_vocabulary(spark, sf_dir):
    from courtside.plans.vocab import position_vocabulary

    wh = _wh(spark, sf_dir)
    return position_vocabulary(wh.src("draft_combine"), wh.src("player_profile"))


def q_entity_dictionary(spark, sf_dir):
    from courtside.plans.vocab import entity_dictionary

    return entity_dictionary(_wh(spark, sf_dir).src("plays"))


def q_play_types(spark, sf_dir):
    from courtside.plans.vocab import play_types

    return play_types(_wh(spark, sf_dir).src("plays"))


# -- data quality ------------------------------------------------------------------------

def q_dq_pk(spark, sf_dir):
    from courtside.operators.quality import dq_primary_key

    return dq_primary_key(_wh(spark, sf_dir).src("lineitem"), ["l_orderkey", "l_linenumber"])


def q_dq_fk(spark, sf_dir):
    from courtside.operators.quality import dq_foreign_key

    wh = _wh(spark, sf_dir)
    plays = wh.src("plays").select("game_id", "eventnum", "player1_id")
    return dq_foreign_key(plays, wh.src("player_info"), ["player1_id"], ["id"])


def q_dq_not_null(spark, sf_dir):
    from courtside.operators.quality import dq_not_null

    return dq_not_null(_wh(spark, sf_dir).src("plays"),
                       ["player1_name", "player2_name", "player3_name", "homedescription", "visitordescription"])


def q_dq_length(spark, sf_dir):
    from courtside.operators.quality import dq_length

    p = _wh(spark, sf_dir).src("plays")
    return dq_length(p, {"homedescription": 45, "visitordescription": 45, "player1_team_city": 20,
                         "player1_name": 20})


def q_preview(spark, sf_dir):
    """O3: the first 20 referees by key (a preview is the feature)."""
    return _wh(spark, sf_dir).referee.orderBy("idArbitro").limit(20)


QUERIES.update({
    "csv_roundtrip": q_csv_roundtrip,
    "table_roundtrip": q_table_roundtrip,
    "unit_convert": q_unit_convert,
    "bucket_weight": _bucket_query("peso_kg", B.WEIGHT_KG,
                                   "peso"),
    "bucket_height": _bucket_query("altura_m", B.HEIGHT_M,
                                   "altura"),
    "bucket_wingspan": _bucket_query("envergadura_m",
                                     B.WINGSPAN_M,
                                     "envergadura"),
    "bucket_reach": _bucket_query("alcance_pie_m", B.REACH_M,
                                  "alcance_pie"),
    "bucket_career": _bucket_query("carrera_anos",
                                   B.CAREER_YEARS,
                                   "carrera_profesional"),
    "position_map": q_position_map,
    "capacity_bucket": q_capacity_bucket,
    "roster": q_roster,
    "roster_measures": q_roster_measures,
    "date_key": q_date_key,
    "venue_key": q_venue_key,
    "season_alias_join": q_season_alias_join,
    "jump_balls": q_jump_balls,
    "blocks": q_blocks,
    "steals": q_steals,
    "stats_outer_merge": q_stats_outer_merge,
    "name_vocabulary": q_name_vocabulary,
    "position_vocabulary": q_position_vocabulary,
    "entity_dictionary": q_entity_dictionary,
    "play_types": q_play_types,
    "dq_pk": q_dq_pk,
    "dq_fk": q_dq_fk,
    "dq_not_null": q_dq_not_null,
    "dq_length": q_dq_length,
    "preview": q_preview,
})


# -- design-note extensions -------------------------------------------------------------

def _ext(fn_name: str):
    def q(spark, sf_dir):
        from courtside.plans import extensions as X

        return getattr(X, fn_name)(_wh(spark, sf_dir).src("plays"))

    q.__name__ = f"q_{fn_name}"
    return q


QUERIES.update({
    "running_score": _ext("running_score"),
    "rebound_split": _ext("rebound_split"),
    "team_game": _ext("team_game"),
    "extra_fouls": _ext("extra_fouls"),
    "play_type_counts": _ext("play_type_counts"),
})


# -- options whose defaults keep the source jobs' behaviour ------------------------

def q_player_game_stats_primary(spark, sf_dir):
    parts = P.participants(P.play_stream(_wh(spark, sf_dir).src("plays")))
    return P.player_game_stats(P.play_flags(parts, attribution="primary"))


def q_play_flags_whole_words(spark, sf_dir):
    parts = P.participants(P.play_stream(_wh(spark, sf_dir).src("plays")))
    return P.play_flags(parts, whole_words=True)


def q_bucket_height_half_open(spark, sf_dir):
    from courtside.plans.dims import unit_conversions

    wh = _wh(spark, sf_dir)
    u = unit_conversions(wh.src("player_profile"), wh.src("draft_combine"))
    return u.select("player_id", B.bucketize("altura_m", B.HEIGHT_M, half_open=True).alias("altura"))


def q_ambiguous_names(spark, sf_dir):
    from courtside.plans.dims import ambiguous_names

    wh = _wh(spark, sf_dir)
    return ambiguous_names(wh.player, wh.team)


def q_fact_by_referee(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    wh.prepare()
    return fact_plan.fact_partido(wh.src("plays"), wh.header, wh.player, grain="referee")


QUERIES.update({
    "player_game_stats_primary": q_player_game_stats_primary,
    "play_flags_whole_words": q_play_flags_whole_words,
    "bucket_height_half_open": q_bucket_height_half_open,
    "ambiguous_names": q_ambiguous_names,
    "fact_by_referee": q_fact_by_referee,
})


# -- loads: CSV without loss, keys that last, checks of the contract tables ----------

def q_csv_lossless(spark, sf_dir):
    """S1/S7: whole texts with line ends, quotes, padding, empty and NULL written as CSV and read back."""
    from courtside.operators.materialize import scratch_path
    from courtside.sources.csv_text import read_checked
    from courtside.sources.files import write_csv

    docs = _wh(spark, sf_dir).src("documents").select("doc_id", F.expr(_ODD_TEXT).alias("text"), "lang")
    path = scratch_path(docs, "csv")
    write_csv(docs, path)
    return read_checked(spark, path, multi_line=True).rows


#: Both dialects read this: texts as they are, padded, quoted, empty or missing.
_ODD_TEXT = ("CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat('  ', text, ' ') WHEN 3 THEN concat('\"', text, '\",') "
             "ELSE text END")
#: A CSV line per customer; some have a field too few or too many, an open quote, or text after a closing one.
_CSV_LINE = ("CASE c_custkey % 8 WHEN 1 THEN concat(cast(c_custkey AS STRING), ',', c_name) "
             "WHEN 2 THEN concat(cast(c_custkey AS STRING), ',', c_name, ',', c_mktsegment, ',more') "
             "WHEN 3 THEN concat(cast(c_custkey AS STRING), ',\"', c_name, ',', c_mktsegment) "
             "WHEN 4 THEN concat(cast(c_custkey AS STRING), ',\"', c_name, '\"x,', c_mktsegment) "
             "WHEN 5 THEN concat(cast(c_custkey AS STRING), ',\"', c_name, ', \"\"Jr\"\"\",') "
             "ELSE concat(cast(c_custkey AS STRING), ',', c_name, ',', c_mktsegment) END")


def q_csv_quarantine(spark, sf_dir):
    """S1: good records and, with their reason and text, the lines that are none."""
    from courtside.operators.materialize import scratch_path
    from courtside.sources.csv_text import read_checked

    cust = _wh(spark, sf_dir).src("customer")
    path = scratch_path(cust, "csv-lines")
    head = spark.range(1).select(F.lit("c_custkey,c_name,c_mktsegment").alias("value"))
    head.unionByName(cust.select(F.expr(_CSV_LINE).alias("value"))).write.text(path)
    got = read_checked(spark, path, header=["c_custkey", "c_name", "c_mktsegment"])  # here only one file has the header
    none = F.lit(None).cast("string")
    return got.rows.select(F.lit("ok").alias("estado"), "c_custkey", "c_name", "c_mktsegment", none.alias("text")).unionByName(
        got.rejects.select(F.col("reason").alias("estado"), none.alias("c_custkey"), none.alias("c_name"), none.alias("c_mktsegment"), "text"))


def _early(spark, sf_dir, keys):
    """The games before 1996 with their officials."""
    src = _wh(spark, sf_dir).src
    games = src("games").where(F.col("game_date") < "1996")
    return Warehouse.from_frames(spark, keys=keys, games=games, officials=src("officials").join(games.select("game_id"), "game_id", "left_semi"))


def q_stable_keys(spark, sf_dir):
    """W2/W3/S5/S6: referee and league ids after a load of the early games and one of all; a staged load shows nothing."""
    from courtside.operators.materialize import scratch_path
    from courtside.plans.releases import Releases

    full = _wh(spark, sf_dir)
    releases = Releases(spark, scratch_path(full.src("orders"), "releases"))

    def stage(make):
        keys = releases.keys()
        wh = make(keys)
        return releases.stage({"arbitro": wh.referee, "liga": wh.league}, keys)

    def seen(moment):
        ref = releases.table("arbitro").select(F.lit(moment).alias("momento"), F.lit("arbitro").alias("tabla"), F.col("idArbitro").alias("id"), "nombre")
        return ref.unionByName(releases.table("liga").select(F.lit(moment).alias("momento"), F.lit("liga").alias("tabla"), F.col("idLiga").alias("id"), "nombre"))

    releases.commit(stage(lambda keys: _early(spark, sf_dir, keys)))
    second = stage(lambda keys: Warehouse(spark, sf_dir, keys=keys))
    before = seen("preparada")  # the second load is written, not committed
    releases.commit(second)
    return before.unionByName(seen("confirmada"))


def q_rebound_events(spark, sf_dir):
    from courtside.plans.extensions import rebound_events

    return rebound_events(_wh(spark, sf_dir).src("plays"))


def q_dq_contracts(spark, sf_dir):
    """Q-PK/Q-FK/Q-NN/Q-LEN on the seven contract tables."""
    from courtside.plans.runner import contract_checks

    return contract_checks(_wh(spark, sf_dir).tables())


def q_dq_fact_by_referee(spark, sf_dir):
    """Q-PK of the fact with a row per official: the eight key columns, in rows and distinct."""
    fact = q_fact_by_referee(spark, sf_dir).select(*fact_plan.KEYS)
    return fact.groupBy(*fact_plan.KEYS).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("filas"), F.count(F.lit(1)).alias("claves"), F.count_if(F.col("n") > 1).alias("repetidas"))


QUERIES.update({
    "csv_lossless": q_csv_lossless,
    "csv_quarantine": q_csv_quarantine,
    "stable_keys": q_stable_keys,
    "rebound_events": q_rebound_events,
    "dq_contracts": q_dq_contracts,
    "dq_fact_by_referee": q_dq_fact_by_referee,
})


# -- names that several players hold ---------------------------------------------------

def _shared_names(spark, sf_dir):
    """The plays and players with the last digit of every name cut off, so that up to ten players share a name."""
    wh = _wh(spark, sf_dir)

    def cut(df, *columns):
        return df.withColumns({c: F.regexp_replace(c, "[0-9]( *)$", "$1") for c in columns})

    plays = cut(wh.src("plays"), *[f"player{i}_name" for i in P.SLOTS])
    frames = {n: wh.src(n) for n in ("player_info", "player_profile", "inactive_players", "draft_combine")}
    return Warehouse.from_frames(spark, plays=plays, **frames)


def q_shared_name_points(spark, sf_dir):
    """J6/J10: points and plays per game and player where names are shared; no row counts for two players."""
    wh = _shared_names(spark, sf_dir)
    out = fact_plan.resolved_measures(wh.src("plays"), wh.player)
    return out.select("game_id", "jugador", "idJugador", "candidatos", "Puntos_Totales", "Numero_Jugadas_Totales")


def q_shared_names(spark, sf_dir):
    """J10: the names that several of those players hold."""
    from courtside.plans.dims import ambiguous_names

    player = _shared_names(spark, sf_dir).player
    return ambiguous_names(player, player.limit(0))


QUERIES.update({"shared_name_points": q_shared_name_points, "shared_names": q_shared_names})
