"""Deterministic dedupe and dense ids."""

from pyspark.sql import functions as F

from courtside.operators.keys import dedupe, dense_rank_ids, desc_nulls_last, number_rows


def test_dedupe_is_deterministic_and_null_aware(spark):
    df = spark.createDataFrame(
        [(1, "b", 3), (1, "a", 5), (1, None, 9), (2, "x", None), (2, "x", 1), (None, "n", 0), (None, "m", 0)],
        "k int, s string, v int")
    out = {r["k"]: (r["s"], r["v"]) for r in dedupe(df, ["k"]).collect()}
    assert out == {1: ("a", 5), 2: ("x", 1), None: ("m", 0)}  # the fullest row of each key
    empty = spark.createDataFrame([(1, ""), (1, None), (1, "z"), (2, None), (2, "")], "k int, s string")
    assert {r["k"]: r["s"] for r in dedupe(empty, ["k"]).collect()} == {1: "z", 2: ""}
    latest = {r["k"]: r["v"] for r in dedupe(df.select("k", "v"), ["k"], order=desc_nulls_last("v")).collect()}
    assert latest == {1: 9, 2: 1, None: 0}
    for parts in (1, 3, 7):
        again = {r["k"]: (r["s"], r["v"]) for r in dedupe(df.repartition(parts), ["k"]).collect()}
        assert again == out


def test_number_rows_dense_in_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit("x").alias("p"))
    for parts in (1, 5):
        ids = number_rows(df, ["k"], "rid", partitions=parts).collect()
        assert sorted(r["rid"] for r in ids) == list(range(1, 1001))
        assert all(r["rid"] == r["k"] + 1 for r in ids)


def test_number_rows_strings_and_nulls(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("c",)], "k string")
    got = {r["k"]: r["i"] for r in number_rows(df, ["k"], "i").collect()}
    assert got == {None: 1, "a": 2, "b": 3, "c": 4}


def test_dense_rank_ids_repeated_keys(spark):
    df = spark.createDataFrame([(10, 1), (10, 2), (3, 1), (7, 5), (3, 9)], "g int, v int")
    got = sorted((r["g"], r["gid"]) for r in dense_rank_ids(df, ["g"], "gid").collect())
    assert got == [(3, 1), (3, 1), (7, 2), (10, 3), (10, 3)]


def test_number_rows_with_aqe_sized_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "37")
        df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"))
        ids = number_rows(df, ["k"], "rid").collect()
        assert sorted(r["rid"] for r in ids) == list(range(1, 5001))
        assert all(r["rid"] == r["k"] + 1 for r in ids)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_dedupe_matches_brute_force_property(spark):
    from hypothesis import given, settings, HealthCheck
    from hypothesis import strategies as st

    rows_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)),
                                 st.one_of(st.none(), st.sampled_from(["a", "b", "B", " a"])),
                                 st.one_of(st.none(), st.integers(-3, 3))), min_size=1, max_size=25)

    def key(v):  # Spark's ascending order with NULL first
        return (v is not None, v if v is not None else 0) if not isinstance(v, str) else (True, v.encode())

    @settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
    @given(rows_st)
    def check(rows):
        df = spark.createDataFrame(rows, "k int, s string, v int")
        got = {r["k"]: (r["s"], r["v"]) for r in dedupe(df, ["k"], order=["v"]).collect()}
        want = {}
        for k, s, v in rows:
            cand = (key(v), (s is None, (s or "").encode()), key(v))
            if k not in want or cand < want[k][0]:
                want[k] = (cand, (s, v))
        assert got == {k: w[1] for k, w in want.items()}

    check()


def test_number_rows_over_many_partitions(spark):
    df = spark.range(0, 300).select(((F.col("id") * 17) % 300).alias("k"))
    ids = number_rows(df, ["k"], "rid", partitions=60).collect()
    assert sorted(r["rid"] for r in ids) == list(range(1, 301))
    assert all(r["rid"] == r["k"] + 1 for r in ids)
    assert number_rows(df.where("k < 0"), ["k"], "rid").count() == 0


def test_broadcast_needs_rows_and_decoded_size_in_bounds(spark):
    from courtside.operators.lookup import fits_broadcast, measured

    df = spark.range(0, 100).select("id", F.repeat(F.lit("x"), 1000).alias("wide"))
    assert measured(df) == (100, 100 * (2 * 16 + 1000))
    assert fits_broadcast(df, 100) and not fits_broadcast(df, 99)
    spark.conf.set("courtside.broadcast.maxBytes", "100000")
    try:
        assert not fits_broadcast(df, 100)
    finally:
        spark.conf.unset("courtside.broadcast.maxBytes")
