"""Steps whose cost grew faster than the tables: combined before they are sorted, packed sums, the fact read twice by its checks."""

from pyspark.sql import functions as F

from courtside.functions.classify import ASKED_WITH, NEEDLES, bit_test, general_rules, needle_bits, text_test
from courtside.operators.keys import dedupe
from courtside.plans import fact as FP
from courtside.plans import plays as P
from courtside.plans import runner as R
from courtside.plans.warehouse import Warehouse


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_collapse_combines_rows_before_the_sorted_minimum(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, ""), (2, None), (2, "b"), (None, "c"), (None, "c")], "k int, v string")
    one = dedupe(df, ["k"], collapse=True)
    assert sorted(one.collect(), key=str) == sorted([(1, "a"), (2, "b"), (None, "c")], key=str) and one.columns == ["k", "v"]
    assert sorted(one.collect(), key=str) == sorted(dedupe(df, ["k"]).collect(), key=str)
    lines = [x for x in _plan(one).splitlines() if "HashAggregate(keys=[k" in x and ", v" in x]
    assert lines  # a plain distinct is dropped by the optimizer


def test_packed_sums_are_exact(spark):
    names = ["a", "b", "c", "d", "e"]
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), *[(F.col("id") % (i + 2) == 0).cast("int").alias(n) for i, n in enumerate(names)])
    packed = df.groupBy("g").agg(*P.packed_sums({n: F.col(n) for n in names}))
    assert packed.columns == ["g", "c0", "c1", "c2"]
    got = P.unpacked(packed, names)
    want = df.groupBy("g").agg(*[F.sum(n).alias(n) for n in names])
    assert sorted(got.collect()) == sorted(want.collect()) and [t for _, t in got.dtypes] == ["bigint"] * 6
    # a row beyond 2^31 in the low half leaves the high half alone
    wide = spark.createDataFrame([((7 << 32) + (1 << 31) + 5,)], "c0 bigint")
    assert P.unpacked(wide, ["low", "high"]).collect() == [((1 << 31) + 5, 7)]


def test_gated_substrings_give_the_same_rules(spark):
    texts = ["", " ", "for", "sub: a for b", "sub", "personal", "personal foul", "p.foul", "s.foul", "l.b.foul", "foul turnover", "offensive", "offensive foul",
             "defensive", "defensive rebound", "offensive rebound", "off.foul", "3pt shot", "miss dunk", "free throw", "timeout", "turnover", None]
    df = spark.createDataFrame([(t,) for t in texts], "d string").select("d", needle_bits(F.col("d")).alias("bits"))
    direct, read = general_rules(text_test(F.col("d"))), general_rules(bit_test(F.col("bits")))
    for row in df.select("d", *[F.struct(F.coalesce(direct[n], F.lit(False)).alias("x"), read[n].alias("y")).alias(n) for n in direct]).collect():
        assert all(row[n].x == row[n].y for n in direct), row.d
    assert set(ASKED_WITH) < set(NEEDLES)


def test_fact_hashes_the_games_and_numbers_ids_from_files(spark, sf_small):
    wh = Warehouse(spark, sf_small)
    for grain in ("game", "referee"):
        plan = _plan(FP.fact_partido(wh.src("plays"), wh.header, wh.player, grain=grain))
        assert "ShuffledHashJoin [game_id" in plan
        assert "orders.parquet" not in plan  # the header is not built a second time


def test_contract_checks_read_the_fact_twice(spark, tmp_path):
    keys = ["idPartido", *R.FACT_REFS]
    fact = spark.createDataFrame([(1, 1, 1, 1, 1, 1, 1, 1), (1, 1, 2, 7, None, 1, 1, 1), (None, 9, 1, 7, 1, None, 1, 2)], ", ".join(f"{k} bigint" for k in keys))
    fact.write.parquet(str(tmp_path / "partido"))
    tables = {d: spark.createDataFrame([(1, "x"), (2, "y" * 46)], f"{k} bigint, nombre string") for d, k in R.DIM_KEYS.items()}
    tables["partido"] = spark.read.parquet(str(tmp_path / "partido"))
    assert _plan(R.contract_checks(tables)).count("FileScan parquet") == 2
    found = {r.control: r.violaciones for r in R.contract_checks(tables).collect()}
    assert {k: v for k, v in found.items() if v and not k.startswith("len_")} == {
        "pk_partido": 1, "nn_partido_idPartido": 1, "fk_idEquipo_Local": 1, "fk_idArbitro": 2, "nn_partido_idLiga": 1, "nn_partido_idFecha": 1}
    assert len(found) == 6 + 1 + 7 + 6 + 8 + 6 and all(found[f"len_{d}_nombre"] == 1 for d in R.DIM_KEYS)
    assert R.dangling_keys(tables["partido"], tables) == {c: {"idEquipo_Local": 1, "idArbitro": 2}.get(c, 0) for c in R.FACT_REFS}
    empty = R.contract_checks(tables | {"partido": tables["partido"].limit(0)}).collect()
    assert len(empty) == len(found) and not any(r.violaciones for r in empty if "partido" in r.control or r.control.startswith("fk_"))


def test_shared_name_candidates_do_not_fan_out(spark):
    plays = spark.createDataFrame([(1, 1, "Ann", None, None, "X", "Y", None, None, None, None, "a free throw", None),
                                   (2, 1, "ann ", None, None, "Z", None, None, None, None, None, "a free throw", None),
                                   (3, 1, "Bo", None, None, None, None, None, None, None, None, "miss a dunk", None)],
                                  "game_id bigint, eventnum int, player1_name string, player2_name string, player3_name string, player1_team_city string, "
                                  "player1_team_nickname string, player2_team_city string, player2_team_nickname string, player3_team_city string, "
                                  "player3_team_nickname string, homedescription string, visitordescription string")
    player = spark.createDataFrame([(1, "Ann", "Q"), (4, "Ann", "X Y"), (3, "ann", "X Y"), (2, "Ann", None), (9, "Bo", "Q"), (8, None, "Q")],
                                   "idJugador bigint, nombre string, equipo string")
    got = FP.resolved_measures(plays, player)
    assert "struct(fits" not in _plan(got)
    assert sorted((r.game_id, r.jugador, r.idJugador, r.candidatos) for r in got.collect()) == [(1, "ann", 3, 4), (2, "ann", 1, 4), (3, "bo", 9, 1)]


def test_measures_are_aggregated_in_half_the_sums(spark, sf_small):
    wh = Warehouse(spark, sf_small)
    for df in (P.game_player_counts(wh.src("plays")), FP.stats_outer_merge(wh.src("plays"), wh.player)):
        sums = [x.count("partial_sum(") for x in _plan(df).splitlines() if "HashAggregate" in x]
        assert max(sums) <= 12
