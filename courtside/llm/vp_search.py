"""Nearest neighbours with a vantage-point tree per shard.

Vectors are dealt over shards by their place, so that copies are dealt too.  In a shard, one task
builds a vantage-point tree: an inner node holds one vector and the median
distance to the rest, which splits them into a near and a far half; leaves
hold up to ``leaf`` vectors.  All queries of a block walk the tree together.
At a node each query first visits its own side.  The other side is visited
unless the triangle inequality, relaxed by ``factor``, excludes it: with gap
g between the query's distance and the median, and t its k-th best distance,
the side is skipped when factor * g > t.  ``factor`` 1 is exact; a larger
one visits less and may miss neighbours.  Distances are Euclidean, computed
in double precision from the original components.  Each shard returns its k
best per query, and a window over those picks the k best of all shards.

Queries (a stated set) meet every shard: every row is searched, no shard is
skipped.  A shard's rows and the queries come sorted in one stream, the rows
first: the tree is built once, whatever the number of queries, which follow
in blocks of ``query_block``.

Defined results: null, zero and empty vectors, those with null or non-finite
components, and rows with a null id take no part.  Only vectors of one
length are compared.  Rows with the query's id are the query's own (an id
asked by several rows is asked once, with the smallest vector); other
repeated rows are candidates each; ties go to the smaller id.  With fewer
candidates than k all are returned; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.common import runs_of, ship_package

FACTOR = 1.15  # recall measured in tests/llm/test_vp_search.py, with small shards and with the defaults below


class VpTree:
    """Vantage-point tree over the rows of a float64 matrix; ids order ties."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int = 64):
        self.x, self.ids, self.leaf = x, ids, leaf
        self.nodes: list[tuple] = []
        self.root = self._build(np.lexsort((np.arange(len(ids)), ids)))

    def _build(self, rows: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(("leaf", rows))
        if len(rows) > self.leaf:
            # The vantage point: of a few evenly spaced rows, the one with the widest spread of distances.
            tries = rows[np.linspace(0, len(rows) - 1, 5).astype(int)]
            probe = rows[np.linspace(0, len(rows) - 1, 64).astype(int)]
            spread = [np.sqrt(((self.x[probe] - self.x[t]) ** 2).sum(1)).std() for t in tries]
            point = tries[int(np.argmax(spread))]
            rest = rows[rows != point]
            d = np.sqrt(((self.x[rest] - self.x[point]) ** 2).sum(1))
            mid = float(np.median(d))
            near = d <= mid
            if near.any() and not near.all():
                self.nodes[at] = ("node", point, mid, self._build(rest[near]), self._build(rest[~near]))
        return at

    def search(self, q: np.ndarray, own: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Per query the k best (distance, id); missing ones have distance inf and id -1."""
        self.q, self.own, self.k, self.factor = q, own, k, factor
        self.d = np.full((len(q), k), np.inf)
        self.i = np.full((len(q), k), -1, np.int64)
        if len(q) and len(self.ids):
            self._visit(self.root, np.arange(len(q)))
        return self.d, self.i

    def _offer(self, who: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Distances of the queries ``who`` to ``rows``; the k best are kept."""
        out = np.empty((len(who), len(rows)))
        step = max(1, (1 << 20) // max(1, len(rows) * self.q.shape[1]))
        for lo in range(0, len(who), step):
            w = who[lo:lo + step]
            d = np.sqrt(((self.q[w][:, None, :] - self.x[rows][None, :, :]) ** 2).sum(2))
            out[lo:lo + step] = d
            ids = np.broadcast_to(self.ids[rows], d.shape)
            d = np.where(ids == self.own[w][:, None], np.inf, d)
            d, ids = np.hstack([self.d[w], d]), np.hstack([self.i[w], ids])
            best = np.lexsort((ids, d))[:, :self.k]
            self.d[w], self.i[w] = np.take_along_axis(d, best, 1), np.take_along_axis(ids, best, 1)
        return out

    def _visit(self, at: int, who: np.ndarray) -> None:
        if not len(who):
            return
        node = self.nodes[at]
        if node[0] == "leaf":
            for lo in range(0, len(node[1]), 1024):
                self._offer(who, node[1][lo:lo + 1024])
            return
        _, point, mid, near, far = node
        gap = self._offer(who, np.array([point]))[:, 0] - mid
        inside = gap <= 0
        self._visit(near, who[inside])
        self._visit(far, who[~inside])
        open_ = self.factor * np.abs(gap) <= self.d[who, self.k - 1]
        self._visit(far, who[inside & open_])
        self._visit(near, who[~inside & open_])


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``_id`` and ``_v`` (array of double) of the rows that take part."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    fit = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()
    bad = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (rows.where(fit).select(F.col(id_col).cast("long").alias("_id"), v.alias("_v"))
            .where(~F.coalesce(bad, F.lit(True)) & F.exists("_v", lambda x: x != 0)))


def search(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, factor: float = FACTOR,
           shard_rows: int = 8192, query_block: int = 2048, leaf: int = 64) -> DataFrame:
    """query_id, rank (from 1), ``id_col``, score (distance), nearest first; ``is_query`` is a condition on ``_id``."""
    ship_package(rows.sparkSession)
    have = valid_vectors(rows, id_col, vec_col)
    n = rows.where(F.col(id_col).isNotNull()).count()  # fixes the number of shards
    shards = max(1, -(-n // shard_rows))
    shard = F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("_shard")
    stored = have.select(shard, F.size("_v").alias("_dim"), F.lit(0).alias("_kind"), "_id", "_v")
    once = have.where(is_query).groupBy("_id").agg(F.min("_v").alias("_v"))
    asked = once.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"), F.size("_v").alias("_dim"), F.lit(1).alias("_kind"), "_id", "_v")
    stream = stored.unionByName(asked).repartition("_shard").sortWithinPartitions("_shard", "_dim", "_kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, tree = None, [], None
        for (number, dim, kind), b in runs_of(batches, 3):
            if (number, dim) != group:
                group, held, tree = (number, dim), [], None
            ids = b.column(3).to_numpy(zero_copy_only=False)
            x = b.column(4).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            if kind == 0:
                held.append((x, ids))
                continue
            if tree is None:
                if not held:
                    continue
                tree = VpTree(*[np.concatenate(part) for part in zip(*held)], leaf)
                held = []
            for lo in range(0, len(ids), query_block):
                q = ids[lo:lo + query_block]
                d, i = tree.search(x[lo:lo + query_block], q, k, factor)
                at, col = np.nonzero(np.isfinite(d))
                yield pa.RecordBatch.from_arrays([pa.array(q[at]), pa.array(i[at, col]), pa.array(d[at, col])], names=["query_id", "_id", "score"])

    found = stream.mapInArrow(run, "query_id bigint, _id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "_id")).cast("int").alias("rank")
    return found.select("query_id", rank, F.col("_id").alias(id_col), "score").where(F.col("rank") <= k)
