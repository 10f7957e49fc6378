import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from courtside.llm import lemp_negatives as L


def moved():
    return F.when(F.col("_id") % 7 == 0, (F.col("_label") + 1) % 10).otherwise(F.col("_label"))


def brute(rows, low=30, high=90, npos=5, nneg=10):
    have = []
    for i, v, label in rows:
        if i is None or v is None or label is None or not len(v) or any(x is None or not np.isfinite(x) for x in v):
            continue
        have.append((i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(x))) for x in v]))
    asked = {}
    for i, label, v in have:
        if i % 100 == 0:
            asked[i] = min(asked.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in asked.items():
        scored = [(-sum(x * y for x, y in zip(v, w)), i, lb) for i, lb, w in have if i != a and len(w) == len(v)]
        scored.sort()
        for s, p, _ in [x for x in scored if x[2] == label][:npos]:
            fit = [(t, n) for t, n, lb in scored if lb != label and low * -s <= 100 * -t <= high * -s][:nneg]
            out += [(a, p, r, n, -s, -t) for r, (t, n) in enumerate(fit, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def made(seed, n, dim, spread=0.0):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, dim))
    x = (centres[rnd.integers(0, 6, n)] + 0.5 * rnd.normal(size=(n, dim))) * np.exp(spread * rnd.normal(size=(n, 1)))
    x = (0.3 * x).astype(np.float32)
    return [(int(i), [float(c) for c in v], int(rnd.integers(0, 10))) for i, v in enumerate(x)]


@pytest.mark.parametrize("seed,dim,spread,shard", [(1, 8, 0.0, 400), (2, 16, 0.8, 250), (3, 3, 1.5, 5000)])
def test_mine_matches_brute_force(spark, seed, dim, spread, shard):
    rows = made(seed, 1200, dim, spread)
    got = sorted(tuple(r) for r in L.mine(table(spark, rows), F.col("_id") % 100 == 0, moved(), shard_rows=shard, bucket_rows=64).collect())
    assert got == brute(rows) and len(got) > 100


def test_mine_matches_sql(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_small}/embeddings.parquet'")
    got = sorted(tuple(r) for r in L.mine(rows, F.col("_id") % 100 == 0, moved()).collect())
    assert got == sorted(tuple(r) for r in con.execute(L.oracle()).fetchall()) and got


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.25], 1), (1, [1.0, 0.4], 1), (2, [0.9, 0.4], 1), (2, [0.9, 0.4], 1), (3, [0.5, 0.4], 2), (4, [0.5, 0.4], 2), (4, [0.5, 0.4], 2),
            (5, None, 1), (6, [1.0, None], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 2), (10, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (11, [], 1), (12, [0.0, 0.0], 2),
            (100, [0.0, 0.0], 3), (101, [-1.0, -1.0], 3), (15, [1.0, 1.0, 1.0], 2), (200, [1.0, 0.1, 0.2], 5), (201, [1.0, 0.3, 0.2], 5), (-100, [0.2, 0.9], 2), (7, [0.6, 0.1], 0)]
    frame = table(spark, rows).selectExpr("*", "1 AS _id", "2 AS _label", "3 AS rank", "'x' AS score")
    got = sorted(tuple(r) for r in L.mine(frame, F.col("_id") % 100 == 0, moved()).collect())
    assert got == brute(rows) and {r[0] for r in got} >= {0, 100, -100}
    assert L.mine(table(spark, []), F.col("_id") % 100 == 0).collect() == []
    assert L.mine(table(spark, rows[:1]), F.col("_id") % 100 == 0).collect() == []


def test_pruning_is_exact_and_prunes():
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(40, 12)) * np.exp(rnd.normal(size=(40, 1)))
    x = np.floor(100 * (centres[rnd.integers(0, 40, 6000)] + 0.05 * rnd.normal(size=(6000, 12)))).astype(np.int32)
    index = L.Index(np.arange(6000), rnd.integers(0, 3, 6000), x, bucket_rows=500)
    seen = checked = 0
    for q in range(0, 6000, 100):
        (ids, score), = index.best(x[q].astype(np.int64), q, 1, False, [(-(1 << 62), 1 << 62)], 10)
        all_ = x.astype(np.int64) @ x[q].astype(np.int64)
        fit = np.array([i for i in range(6000) if i != q and index.labels[np.nonzero(index.ids == i)[0][0]] != 1])
        best = fit[np.lexsort((fit, -all_[fit]))][:10]
        assert ids.tolist() == best.tolist() and score.tolist() == all_[best].tolist()
        norm = np.sqrt((x[q].astype(float) ** 2).sum())
        for b in index.buckets:
            at = b.feasible(x[q] / norm, np.argsort(-np.abs(x[q]), kind="stable")[:4], norm, float(score[-1]))
            seen, checked = seen + len(b.rows), checked + (len(b.rows) if at is None else len(at))
    assert checked < seen / 3


def test_large_components_stay_exact():
    x = np.array([[1 << 26, 3], [(1 << 26) + 1, -7], [5, 5]], np.int32)
    index = L.Index(np.arange(3), np.zeros(3, np.int64), x)
    (ids, score), = index.best(np.array([(1 << 26) + 1, 1]), 99, 0, True, [(-(1 << 62), 1 << 62)], 3)
    assert score.tolist() == [((1 << 26) + 1) ** 2 - 7, (1 << 26) * ((1 << 26) + 1) + 3, 5 * ((1 << 26) + 1) + 5] and ids.tolist() == [1, 0, 2]
