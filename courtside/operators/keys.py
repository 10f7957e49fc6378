"""Deterministic deduplication and dense surrogate keys.

``dedupe`` keeps one row per key with a total order, as an aggregation
(``min`` over a struct) so Spark combines map-side and a hot key never
lands whole in one task.  ``number_rows`` / ``dense_rank_ids`` hand out
dense ids 1..n in key order without a single-partition window over the
data: rows are range-partitioned and sorted, the partitioned frame is
written with each row's (partition, position) to a Parquet table under
``spark.checkpoint.dir`` so both passes agree, and each row gets
``offset(partition) + position``.  The offsets are a running sum over one
count per partition, broadcast to the rows; nothing reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.operators.materialize import materialize

ColumnLike = str | Column


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nulls_last(c: ColumnLike) -> list[Column]:
    """Ascending order with NULL after every value (for ``order`` lists)."""
    c = _col(c)
    return [c.isNull(), c]


def desc_nulls_last(c: ColumnLike) -> list[Column]:
    """Descending order of a numeric column with NULL last."""
    c = _col(c)
    return [c.isNull(), -c]


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike] = (), collapse: bool = False) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (ascending, NULL first),
    ties broken by every remaining column, so the result is deterministic.
    Ties prefer the fuller row: in each remaining column a value comes
    before an empty text, and that before NULL.

    NULL keys form one group, like ``dropDuplicates``.  ``collapse`` first
    removes identical rows with a hash aggregation (map-side combined): worth
    it when rows repeat heavily (e.g. one row per play slot), since the
    struct minimum itself is a sort-based aggregation.  Their number goes along
    as the last, never deciding, place of the order: Spark drops a plain
    ``distinct`` below a minimum.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    if collapse:
        df = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_rows"))
    ordering = [_col(o).alias(f"_o{i}") for i, o in enumerate(order)]
    types = dict(df.dtypes)
    for i, c in enumerate(payload):
        ordering.append(F.col(c).isNull().alias(f"_n{i}"))
        if types[c] == "string":
            ordering.append((F.col(c) == "").alias(f"_e{i}"))
        ordering.append(F.col(c))
    if collapse:
        ordering.append(F.col("_rows"))
    best = F.min(F.struct(*ordering)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in payload])


def number_rows(df: DataFrame, order: Sequence[str], id_col: str, start: int = 1,
                partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... in ``order`` (ascending, NULL first).

    ``order`` should identify rows uniquely; ties get distinct ids in an
    unspecified order.  Rows are range-partitioned and sorted; each row's
    (partition, position) is stored with it in a Parquet table under the
    checkpoint folder, so the count pass and the numbering pass agree
    whatever the file splits are on reading.
    """
    mid = F.monotonically_increasing_id()
    # Without an explicit count AQE sizes the range partitions (it merges
    # adjacent ranges, so order is kept); tiny inputs do not fan out.
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged = (ranged.sortWithinPartitions(*order)
              .select("*", F.shiftright(mid, 33).alias("_pid"),
                      (mid.bitwiseAND(F.lit((1 << 33) - 1))).alias("_pos")))
    numbered = materialize(ranged, f"rows-{id_col}")
    # One row per partition (bounded by the partition count, not the data).
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    ided = numbered.join(F.broadcast(offsets), "_pid").select(
        *df.columns, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("bigint").alias(id_col))
    # Written once more, so consumers read a plain Parquet scan with exact
    # file statistics and don't repeat the join.
    return materialize(ided, f"ids-{id_col}")


def stable_ids(df: DataFrame, order: Sequence[str], id_col: str, known: DataFrame | None = None) -> DataFrame:
    """``number_rows`` that keeps the ids of an earlier load.

    ``known`` holds the keys (``order``) and ``id_col`` given out before, each
    key once.  Rows with a known key keep its id; the others are numbered in
    key order from the largest known id on, so no id is given twice or moved.
    Keys compare null-safe.  Rows must be unique in ``order``.
    """
    if known is None:
        return number_rows(df, order, id_col)
    from courtside.operators.lookup import checked_broadcast

    side = known.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(order)], F.col(id_col).alias("_kid"))
    side = checked_broadcast(side)
    same = None
    for i, k in enumerate(order):
        one = df[k].eqNullSafe(side[f"_k{i}"])
        same = one if same is None else same & one
    kept = df.join(side, same).select(*[df[c] for c in df.columns], F.col("_kid").cast("bigint").alias(id_col))
    largest = known.agg(F.max(id_col)).first()[0]  # one number
    new = number_rows(df.join(side, same, "left_anti"), order, id_col, start=(largest or 0) + 1)
    return kept.unionByName(new)


def dense_rank_ids(df: DataFrame, keys: Sequence[str], id_col: str, lookup_rows: int | None = None) -> DataFrame:
    """Attach ``id_col`` = dense rank (1..n) of ``keys`` among the distinct keys of ``df``."""
    from courtside.operators.lookup import lookup

    ids = number_rows(df.select(*keys).distinct(), keys, id_col)
    return lookup(df, ids, list(keys), list(keys), [id_col], how="inner", null_safe=True, max_rows=lookup_rows)
