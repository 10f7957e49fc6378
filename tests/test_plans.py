"""Plan shape: one scan of the plays, no Python workers, no single-partition
exchange over data rows, pruned scans; chunked running sums."""

from pyspark.sql import functions as F

from courtside.plans import extensions as X
from courtside.plans import fact as FP
from courtside.plans import vocab as V
from courtside.plans.warehouse import Warehouse


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_reads_plays_once_without_python(spark, sf_small):
    wh = Warehouse(spark, sf_small)
    plan = _plan(FP.player_measures(wh.src("plays"), wh.player))
    assert plan.count("lineitem.parquet") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "SinglePartition" not in plan


def test_header_and_dictionary_read_their_tables_once(spark, sf_small):
    wh = Warehouse(spark, sf_small)
    plan = _plan(FP.game_keys(wh.header))
    # the games once; the adapter's officials take two more scans of the orders
    assert plan.count("orders.parquet") == 3
    assert "BatchEvalPython" not in plan and "SinglePartition" not in plan
    assert _plan(V.entity_dictionary(wh.src("plays"))).count("lineitem.parquet") == 1


def test_lineitem_scan_is_pruned(spark, sf_small):
    wh = Warehouse(spark, sf_small)
    scan = [ln for ln in _plan(FP.player_measures(wh.src("plays"), wh.player)).splitlines() if "lineitem.parquet" in ln][0]
    for unused in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_returnflag"):
        assert unused not in scan


def test_no_python_or_single_partition_exchange_in_any_query(spark, sf_small):
    import __spark_entry__ as E

    from courtside.catalog import QUERIES

    for name, q in ((n, E.queries()[n]) for n in QUERIES):  # the star schema's; optional modules have tests of their own
        plan = _plan(q(spark, sf_small))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                # allowed only between the partial and final step of a global
                # aggregate: one row per partition crosses it, not data rows
                assert "HashAggregate(keys=[]" in lines[i - 1], name
                assert "HashAggregate(keys=[], functions=[partial_" in lines[i + 1], name


def test_running_sum_chunks_match_window(spark):
    from pyspark.sql import Window

    df = spark.range(0, 500).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"),
                                    ((F.col("id") * 7) % 5).alias("v"))
    got = X.running_sum(df, "g", "o", ["v"], chunk=16)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("g", "o", "v", F.sum("v").over(w).alias("acum_v"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_fact_independent_of_shuffle_partitions(spark, sf_small):
    import __spark_entry__ as E

    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(tuple(r) for r in E.queries()["fact_partido"](spark, sf_small).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] and len(results[0]) > 0


def test_shuffle_join_fallback_gives_same_results(spark, sf_small):
    """With a tiny broadcast bound every lookup and the dictionary join take
    the sort-merge path (as with dimensions too large to broadcast)."""
    import __spark_entry__ as E

    def run(name):
        return sorted(tuple(r) for r in E.queries()[name](spark, sf_small).collect())

    base = {n: run(n) for n in ("fact_partido", "play_types")}
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("courtside.broadcast.maxRows", "3")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n, rows in base.items():
            assert run(n) == rows, n
        plan = E.queries()["fact_partido"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    finally:
        spark.conf.unset("courtside.broadcast.maxRows")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_filters_reach_parquet_scan(spark, sf_small):
    wh = Warehouse(spark, sf_small)
    plan = _plan(wh.src("player_info").where("full_name = 'x'"))
    scan = [ln for ln in plan.splitlines() if "supplier.parquet" in ln][0]
    assert "PushedFilters: [IsNotNull(s_name), EqualTo(s_name,x)]" in scan


def test_csv_landing_is_text_and_pruned(spark, tmp_path):
    from courtside.sources.files import read_csv_text, write_csv

    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "k int, s string, x double")
    path = str(tmp_path / "csv")
    write_csv(df, path)
    back = read_csv_text(spark, path, ["k", "x"])
    assert [f.dataType.simpleString() for f in back.schema.fields] == ["string", "string"]
    scan = [ln for ln in _plan(back).splitlines() if "FileScan csv" in ln][0]
    assert "ReadSchema: struct<k:string,x:string>" in scan
    assert sorted(tuple(r) for r in back.collect()) == [("1", "2.5"), ("2", None)]


def test_roster_measures_join_on_both_keys(spark, sf_small):
    import __spark_entry__ as E

    measures, joined = (E.queries()[n](spark, sf_small).collect() for n in ("derived_metrics", "roster_measures"))
    teams = {(r.game_id, r.jugador): r.nombre_equipo for r in E.queries()["roster"](spark, sf_small).collect()}
    got = {(r.game_id, r.jugador): tuple(r)[:-1] for r in joined}
    assert len(got) == len(joined) > 0 and all(r.nombre_equipo == teams[r.game_id, r.jugador] for r in joined)
    assert got == {(r.game_id, r.jugador): tuple(r) for r in measures}  # the roster holds every player with measures


def test_texts_are_classified_below_the_slot_explode(spark, sf_small):
    from courtside.plans import plays as P

    wh = Warehouse(spark, sf_small)
    lines = _plan(P.game_player_measures(wh.src("plays"))).splitlines()
    explode = next(i for i, line in enumerate(lines) if "Generate posexplode" in line)
    assert not any("Contains(" in line for line in lines[:explode + 1]) and any("free throw" in line for line in lines[explode:])
    old = P.derived_metrics(P.player_game_stats(P.play_flags(P.participants(P.play_stream(wh.src("plays"))))))
    new = P.game_player_measures(wh.src("plays"))
    assert old.exceptAll(new).count() == 0 and new.exceptAll(old).count() == 0
