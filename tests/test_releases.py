"""Lasting keys, loads that are visible whole or not at all, partition overwrite."""

import uuid

import pytest
from pyspark.sql import functions as F

from courtside.operators.keys import stable_ids
from courtside.plans.releases import Releases
from courtside.plans.runner import load_release
from courtside.plans.warehouse import Warehouse
from courtside.sources.adapter import Sources
from courtside.sources.files import overwrite_partitions, replace_table
from courtside.sources.schemas import CONTRACT_DDL

#: Natural keys by id column, as the sources name them.
ID = {"equipo": "idEquipo", "arbitro": "idArbitro", "liga": "idLiga", "ubicacion": "idUbicacion", "jugador": "idJugador"}


def test_known_keys_keep_their_ids(spark):
    rows = spark.createDataFrame([("b", 1), ("d", 2), (None, 3)], "k string, v int")
    first = stable_ids(rows, ["k"], "id")
    assert {r.k: r.id for r in first.collect()} == {None: 1, "b": 2, "d": 3}
    more = spark.createDataFrame([("a", 1), ("b", 9), ("c", 2), (None, 3), ("e", 4)], "k string, v int")
    second = stable_ids(more, ["k"], "id", first.select("k", "id"))
    assert {r.k: (r.id, r.v) for r in second.collect()} == {None: (1, 3), "b": (2, 9), "a": (4, 1), "c": (5, 2), "e": (6, 4)}
    assert stable_ids(more.limit(0), ["k"], "id", first.select("k", "id")).count() == 0


def test_two_part_keys_and_an_empty_store(spark):
    known = spark.createDataFrame([], "a string, b string, id long")
    rows = spark.createDataFrame([("x", None), ("x", "y"), (None, None)], "a string, b string")
    assert sorted(r.id for r in stable_ids(rows, ["a", "b"], "id", known).collect()) == [1, 2, 3]
    known = spark.createDataFrame([("x", None, 7)], "a string, b string, id long")
    assert {(r.a, r.b): r.id for r in stable_ids(rows, ["a", "b"], "id", known).collect()} == {("x", None): 7, (None, None): 8, ("x", "y"): 9}


def early(spark, sf_dir, keys):
    """A warehouse of the games before 1996, their officials and plays."""
    src = Sources(spark, sf_dir)
    games = src.games.where(F.col("game_date") < "1996")
    ids = games.select("game_id")
    names = ("teams", "team_details", "team_history", "team_list", "player_info", "player_profile", "inactive_players", "draft_combine")
    frames = {n: getattr(src, n) for n in names}
    return Warehouse.from_frames(spark, keys=keys, games=games, officials=src.officials.join(ids, "game_id", "left_semi"),
                                 plays=src.plays.join(ids, "game_id", "left_semi"), **frames)


def rows(df):
    return sorted(map(str, df.collect()))


def test_second_load_keeps_ids_and_a_failed_one_changes_nothing(spark, sf_small, tmp_path):
    place = str(tmp_path / "stats")
    load_release(spark, place, lambda keys: early(spark, sf_small, keys))
    releases = Releases(spark, place)
    assert releases.current() == 1
    first = {t: rows(releases.table(t)) for t in CONTRACT_DDL}
    keys = {c: {tuple(r)[:-1]: r[c] for r in releases.table(f"keys/{c}").collect()} for c in (*ID.values(), "idPartido")}
    assert len(first["partido"]) > 100

    # A load that breaks in its last table, after six are written.
    def broken(store):
        wh = early(spark, sf_small, store)
        wh.partido = wh.partido.withColumn("Puntos_Totales", F.raise_error(F.lit("lost"))).select(*wh.partido.columns)
        return wh

    with pytest.raises(Exception, match="lost"):
        load_release(spark, place, broken)
    assert releases.current() == 1 and {t: rows(releases.table(t)) for t in CONTRACT_DDL} == first

    # A load whose checks fail.
    def doubled(store):
        wh = early(spark, sf_small, store)
        wh.league = wh.league.unionByName(wh.league)
        return wh

    with pytest.raises(ValueError, match="pk_liga"):
        load_release(spark, place, doubled)
    assert releases.current() == 1 and {t: rows(releases.table(t)) for t in CONTRACT_DDL} == first

    # All games: more keys, none moved.
    load_release(spark, place, lambda keys: Warehouse(spark, sf_small, keys=keys), partition_fact=True)
    assert releases.current() == 2
    for c, before in keys.items():
        after = {tuple(r)[:-1]: r[c] for r in releases.table(f"keys/{c}").collect()}
        assert before.items() <= after.items() and sorted(after.values()) == list(range(1, len(after) + 1)), c
    assert len(keys["idPartido"]) < releases.table("keys/idPartido").count()
    old = {r.idJugador: r.nombre for r in releases.table("jugador", 1).collect()}
    new = {r.idJugador: r.nombre for r in releases.table("jugador").collect()}
    assert old.items() <= new.items()

    db = f"rel_{uuid.uuid4().hex[:8]}"
    try:
        releases.publish(db, ["liga", "partido"])
        assert spark.table(f"{db}.partido").count() == releases.table("partido").count()
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    with pytest.raises(ValueError, match="does not follow"):
        releases.commit(2)


def test_no_load_yet(spark, tmp_path):
    releases = Releases(spark, str(tmp_path / "none"))
    assert releases.current() == 0 and releases.keys().known("idLiga") is None
    with pytest.raises(ValueError, match="no committed load"):
        releases.table("liga")


def test_only_changed_leagues_are_replaced(spark, sf_small, tmp_path):
    db = f"part_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path / 'db'}'")
    try:
        fact = Warehouse(spark, sf_small).partido
        replace_table(fact, f"{db}.partido", partition_by=["idLiga"])
        before = {r.idLiga: r["n"] for r in spark.table(f"{db}.partido").groupBy("idLiga").agg(F.count("*").alias("n")).collect()}
        league = sorted(x for x in before if x)[0]
        overwrite_partitions(fact.where(F.col("idLiga") == league).limit(3), f"{db}.partido")
        after = {r.idLiga: r["n"] for r in spark.table(f"{db}.partido").groupBy("idLiga").agg(F.count("*").alias("n")).collect()}
        assert after == before | {league: 3}
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
