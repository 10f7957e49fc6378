"""Hard negatives by LEMP-style coordinate pruning.

A row's score for an anchor is the integer inner product of the scaled
vectors.  An anchor's positives are its best rows of the same label; its
hard negatives are the best rows of other labels whose score lies in a
window below the positive's score.

Rows are dealt over shards of about ``shard_rows``, whatever their ids.  A
shard's index (``Index``) sorts its rows by length (Euclidean norm) into
buckets; in a bucket every coordinate of the unit vectors has a sorted list.
An anchor asks with a threshold: the score that a row must reach to matter.

* Lengths descend from bucket to bucket, so the search ends at the first
  bucket whose longest row cannot reach the threshold (score <= |q| |p|).
* In a bucket the threshold gives a least cosine c.  For a focus coordinate
  with the anchor's unit value a, only unit values in
  [a c - r, a c + r], r = sqrt((1 - a^2) (1 - c^2)), are feasible (open
  towards 1 if a >= c, towards -1 if -a >= c).  Two binary searches in the
  sorted list give that range; the rows found in the ranges of all focus
  coordinates (the anchor's largest ones) are the candidates.
* Candidates are verified by the exact inner product, and the threshold
  rises to the worst of the best rows so far.

Nothing is missed: ranges are exact bounds, widened by ``SLACK`` against
rounding.  Two searches run one after the other: positives, then negatives
with every positive's window.  Each shard returns its best rows per anchor
(and positive), and a window over those picks the best of all shards.

A shard's rows and the anchors (a stated query set, which meets every shard)
come sorted in one stream: the rows first, from which the index is built
once, then the anchors batch by batch.  So a task holds one shard's index
and one batch, however many anchors there are.

Defined results: rows with a null id, label or vector, an empty vector, or a
null or non-finite component take no part; neither do rows with a component
of 2^27 or more after scaling, whose products would leave 64-bit integers.
Only vectors of one length are compared.  Rows with the anchor's id are the
anchor's own (an id that several rows have asks once, with the smallest
label, then vector); other repeated rows count each, ties go to the smaller
id.  Too few rows give fewer results, an empty table an empty one.  Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.common import runs_of, ship_package
from courtside.operators.materialize import materialize

SLACK = 1e-9
LIMIT = 1 << 27


class Bucket:
    """Rows of similar length: unit vectors and a sorted list per coordinate."""

    def __init__(self, rows: np.ndarray, x: np.ndarray, length: np.ndarray):
        self.rows, self.longest, self.shortest = rows, float(length[0]), float(length[-1])
        unit = x[rows] / np.where(length > 0, length, 1)[:, None]
        self.order = np.argsort(unit, 0, kind="stable").T.astype(np.int32)  # coordinate -> rows of the bucket by value
        self.values = np.sort(unit, 0).T.copy()

    def feasible(self, a: np.ndarray, focus: np.ndarray, norm: float, threshold: float) -> np.ndarray | None:
        """Rows that may reach the threshold; None if all may.  ``a``: the anchor's unit vector."""
        if threshold == -np.inf or norm == 0:
            return None if threshold <= 0 else np.empty(0, np.int64)
        reach = norm * (self.longest if threshold > 0 else self.shortest)
        if reach == 0:
            return None if threshold <= 0 else np.empty(0, np.int64)
        c = threshold / reach - SLACK
        if c > 1:
            return np.empty(0, np.int64)
        if c <= -1:
            return None
        n, met, lists = len(self.rows), np.zeros(len(self.rows), np.int16), 0
        for f in focus:
            r = np.sqrt((1 - a[f] ** 2) * (1 - c * c)) if a[f] ** 2 < 1 else 0.0
            low = -np.inf if -a[f] >= c else a[f] * c - r - SLACK
            high = np.inf if a[f] >= c else a[f] * c + r + SLACK
            start, end = np.searchsorted(self.values[f], [low, high], "left")
            end = n if high == np.inf else np.searchsorted(self.values[f], high, "right")
            if end - start < n:
                met[self.order[f, start:end]] += 1
                lists += 1
        return np.nonzero(met == lists)[0] if lists else None


class Index:
    """Length buckets over the integer vectors of one shard."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, bucket_rows: int = 1024, ratio: float = 0.9, focus: int = 4):
        exact = float(np.abs(x).max(initial=0)) ** 2 * x.shape[1] < 2.0 ** 53  # then products are exact in float64 too
        length = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        by = np.lexsort((ids, -length))
        self.ids, self.labels, self.x, self.focus = ids[by], labels[by], x[by].astype(np.float64 if exact else np.int64), focus
        length, self.buckets, lo = length[by], [], 0
        self.exact_below = 2.0 ** 53 / max(1.0, float(np.abs(x).max(initial=0)) * x.shape[1])
        while lo < len(by):
            alike = int(np.searchsorted(-length, -length[lo] * ratio, "right"))
            hi = max(lo + 1, min(alike, lo + bucket_rows))
            self.buckets.append(Bucket(np.arange(lo, hi), self.x, length[lo:hi]))
            lo = hi

    def best(self, q: np.ndarray, own: int, label: int, same: bool, windows: list[tuple], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window (low, high) the k best (ids, scores) of the rows of the same, or of other, labels; not of the anchor's own."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(windows)
        if not windows:
            return found
        norm = float(np.sqrt((q.astype(np.float64) ** 2).sum()))
        unit = q / norm if norm else q.astype(np.float64)
        focus = np.argsort(-np.abs(unit), kind="stable")[:self.focus]
        x = self.x if float(np.abs(q).max(initial=0)) < self.exact_below else self.x.astype(np.int64)
        asked = q.astype(x.dtype)
        for bucket in self.buckets:
            threshold = min(max(low, float(s[-1]) if len(s) == k else -np.inf) for (low, _), (_, s) in zip(windows, found))
            if threshold > norm * bucket.longest * (1 + SLACK) + SLACK:
                break  # lengths descend; no later row can matter
            at = bucket.feasible(unit, focus, norm, threshold)
            rows = bucket.rows if at is None else bucket.rows[at]
            rows = rows[((self.labels[rows] == label) == same) & (self.ids[rows] != own)]
            if not len(rows):
                continue
            score = (x[rows] @ asked).astype(np.int64)
            for j, (low, high) in enumerate(windows):
                fit = (score >= low) & (score <= high)
                if fit.any():
                    ids = np.concatenate([found[j][0], self.ids[rows[fit]]])
                    s = np.concatenate([found[j][1], score[fit]])
                    top = np.lexsort((ids, -s))[:k]
                    found[j] = ids[top], s[top]
        return found


def prepared(rows: DataFrame, id_col: str, vec_col: str, label_col: str, label: Column, scale: int) -> DataFrame:
    """``_id``, ``_label`` (``label`` computed from ``_id`` and ``_label``), ``_v`` (integers) of the rows that take part."""
    v = F.transform(F.col(vec_col), lambda x: scale * x.cast("double"))
    some = rows.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("long").alias("_label"), v.alias("_x"))
    bad = F.exists("_x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LIMIT))
    kept = some.where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & F.col("_x").isNotNull() & (F.size("_x") > 0)).where(~bad)
    return kept.select("_id", label.cast("long").alias("_label"), F.transform("_x", lambda x: F.floor(x).cast("int")).alias("_v"))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _search(table: DataFrame, anchors: DataFrame, shards: int, same: bool, k: int, share: tuple[int, int] | None, options: dict) -> DataFrame:
    """anchor_id, place, positive_id, positive_score, _id, score: per shard the k best rows per anchor and window.

    ``anchors``: ``_id``, ``_label``, ``_v``, ``_w``, an array of (id, score), one per window.  ``share`` (low, high) bounds a
    window's scores by per cent of its score; None: no bounds.
    """
    ship_package(table.sparkSession)
    window = "array<struct<id:bigint,score:bigint>>"
    shard = F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")  # by place, so that copies of a row are dealt too
    stored = table.select(shard.alias("_shard"), F.size("_v").alias("_dim"), F.lit(0).alias("_kind"), "_id", "_label", "_v", F.lit(None).cast(window).alias("_w"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"), F.size("_v").alias("_dim"), F.lit(1).alias("_kind"),
                           "_id", "_label", "_v", F.col("_w").cast(window))
    stream = stored.unionByName(asked).repartition("_shard").sortWithinPartitions("_shard", "_dim", "_kind")
    names = ["anchor_id", "place", "positive_id", "positive_score", "_id", "score"]

    def bounds(score: int) -> tuple[int, int]:
        """The whole numbers s with low * score <= 100 * s <= high * score."""
        return (-(1 << 62), 1 << 62) if share is None else (-(-share[0] * score // 100), share[1] * score // 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, index = None, [], None
        for (number, dim, kind), b in runs_of(batches, 3):
            if (number, dim) != group:
                group, held, index = (number, dim), [], None
            ids, labels, x = b.column(3).to_numpy(zero_copy_only=False), b.column(4).to_numpy(zero_copy_only=False), _matrix(b.column(5))
            if kind == 0:
                held.append((ids, labels, x.astype(np.int32)))
                continue
            if index is None:
                if not held:
                    continue
                index = Index(*[np.concatenate(part) for part in zip(*held)], **options)
                held = []
            out = []
            for own, label, q, windows in zip(ids.tolist(), labels.tolist(), x, b.column(6).to_pylist()):
                best = index.best(q, own, label, same, [bounds(w["score"]) for w in windows], k)
                for place, (w, (who, score)) in enumerate(zip(windows, best)):
                    out.append((*(np.full(len(who), v, np.int64) for v in (own, place, w["id"], w["score"])), who, score))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=names)

    return stream.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def mine(rows: DataFrame, is_anchor: Column, label: Column | None = None, low: int = 30, high: int = 90, id_col: str = "vec_id",
         vec_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 10, scale: int = 256,
         shard_rows: int = 16384, **options) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on ``_id``, ``label`` an expression of ``_id`` and ``_label`` that replaces the label.
    A negative's score in per cent of the positive's lies in ``low`` to ``high``.  ``options``: see ``Index``.
    """
    table = prepared(rows, id_col, vec_col, label_col, F.col("_label") if label is None else label, scale)
    n = rows.where(F.col(id_col).isNotNull()).count()
    shards = max(1, -(-n // shard_rows))
    anchors = materialize(table.where(is_anchor).groupBy("_id").agg(F.min(F.struct("_label", "_v")).alias("_one"))
                          .select("_id", "_one.*"), "lemp-anchors")
    one = F.array(F.struct(F.lit(0).alias("id"), F.lit(0).alias("score")))
    near = _search(table, anchors.withColumn("_w", one), shards, True, positives, None, options)
    first = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "_id"))
    wanted = (near.select("anchor_id", "_id", "score", first.alias("rank")).where(F.col("rank") <= positives)
              .groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct(F.col("_id").alias("id"), "score"))).alias("_w")))
    with_windows = materialize(anchors.join(wanted, anchors["_id"] == wanted["anchor_id"]).select("_id", "_label", "_v", "_w"), "lemp-windows")
    far = _search(table, with_windows, shards, False, negatives, (low, high), options)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(F.col("score").desc(), "_id")).cast("int")
    return far.select("anchor_id", "positive_id", rank.alias("rank"), F.col("_id").alias("negative_id"), "positive_score",
                      F.col("score").alias("negative_score")).where(F.col("rank") <= negatives)


def oracle(low: int = 30, high: int = 90, positives: int = 5, negatives: int = 10, scale: int = 256) -> str:
    """DuckDB SQL on ``embeddings``: every anchor against every row."""
    return f"""
WITH r AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS aid, b.id AS bid, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM r a JOIN r b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.v) = len(b.v)),
pos AS (SELECT aid, bid, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY aid ORDER BY score DESC, bid) <= {positives})
SELECT aid AS anchor_id, pos.bid AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.bid AS negative_id,
    pos.score AS positive_score, s.score AS negative_score
FROM pos JOIN s USING (aid) WHERE NOT s.same AND {low} * pos.score <= 100 * s.score AND 100 * s.score <= {high} * pos.score
WINDOW w AS (PARTITION BY aid, pos.bid ORDER BY s.score DESC, s.bid)
QUALIFY row_number() OVER w <= {negatives}"""
