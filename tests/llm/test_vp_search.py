import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.llm import vp_search as V


def brute(rows, queries, k):
    x = np.array([v for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    out = {}
    for q in queries:
        v = x[ids == q][0]
        d = np.sqrt(((x - v) ** 2).sum(1))
        keep = ids != q
        order = np.lexsort((ids[keep], d[keep]))[:k]
        out[q] = [(int(ids[keep][o]), float(d[keep][o])) for o in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_factor_one_is_exact_with_ties_and_many_shards(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.integers(0, 3, 4) + (0.5 if i % 2 else 0)]) for i in range(600)]
    rows = [(i, v) for i, v in rows if any(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(V.search(df, F.col("_id") % 50 == 0, factor=1.0, shard_rows=100, query_block=5, leaf=8))
    want = brute(rows, sorted(got), 10)
    assert got == want and len(got) >= 11


def test_recall_on_the_table(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/../sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = found(V.search(df, F.col("_id") % 100 == 0, shard_rows=500))
    want = brute(rows, sorted(got), 10)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want])
    print("recall", recall)
    assert recall >= 0.95
    for q in got:
        exact = dict(want[q])
        assert all(s == pytest.approx(exact[i], abs=1e-12) for i, s in got[q] if i in exact)


def test_recall_with_the_registered_defaults(spark, sf_small):
    path = f"{sf_small}/../check_l/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("large test data not present")
    df = spark.read.parquet(path)  # 7 shards of up to 8192 rows
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert len(rows) > 5 * 8192
    got = found(V.search(df, F.col("_id") % 100 == 0))
    want = brute(rows, sorted(got), 10)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want])
    print("recall with the defaults", len(want), recall)
    assert len(want) > 500 and recall >= 0.95


@pytest.mark.parametrize("kind", ["clusters", "sphere"])
def test_recall_with_the_defaults_on_made_shards(spark, tmp_path, kind):
    """Six shards of up to 8192 rows, as many as it takes to show what pruning by shard loses."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    r = np.random.default_rng(7)
    n, dim = 45_000, 64
    x = r.normal(size=(n, dim)) + (2 * r.normal(size=(200, dim))[r.integers(0, 200, n)] if kind == "clusters" else 0)
    x = (x / np.sqrt((x ** 2).sum(1))[:, None]).astype(np.float32)
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": pa.FixedSizeListArray.from_arrays(x.reshape(-1), dim).cast(pa.list_(pa.float32()))}), tmp_path / "e.parquet")
    got = found(V.search(spark.read.parquet(str(tmp_path / "e.parquet")), F.col("_id") % 300 == 0))
    assert len(got) == n // 300 and all(len(g) == 10 for g in got.values())
    x, hits = x.astype(float), 0
    for q, mine in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(n), d))[:10]
        hits += len({i for i, _ in mine} & set(best.tolist()))
        assert all(s == pytest.approx(d[i], abs=1e-12) for i, s in mine)
    recall = hits / (10 * len(got))
    print("recall with the defaults", kind, recall)
    assert recall >= 0.95


def test_query_blocks_and_copies(spark):
    """Small query blocks change nothing; copies of one id are dealt over the shards."""
    rows = spark.range(400).selectExpr("id AS vec_id", "array(cast(id AS double), 1D) AS embedding")
    want = found(V.search(rows, F.col("_id") % 4 == 0, factor=1.0, shard_rows=100))
    assert found(V.search(rows, F.col("_id") % 4 == 0, factor=1.0, shard_rows=100, query_block=7)) == want and len(want) == 100
    copies = spark.range(0, 3000, 1, 4).selectExpr("5L AS vec_id", "array(1D, 2D) AS embedding")  # one id, many rows: dealt over the shards
    got = V.search(copies.unionByName(rows), F.col("_id") == 0, factor=1.0, shard_rows=200)
    assert [r.vec_id for r in got.orderBy("rank").collect()] == [1] + [5] * 9


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (None, [1.0, 1.0]),
            (6, [3.0, 2.0, 1.0]), (7, []), (8, [float("inf"), 0.0]), (100, [5.0, 2.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = found(V.search(df, F.col("_id") % 100 == 0))
    assert got == {0: [(1, 0.0), (1, 0.0), (100, 4.0)], 100: [(0, 4.0), (1, 4.0), (1, 4.0)]}
    assert V.search(df.limit(0), F.col("_id") % 100 == 0).count() == 0
