"""Key lookups (natural key -> surrogate key) with a checked broadcast.

A dimension is broadcast only after one aggregation proves that it has at
most ``max_rows`` rows and that its decoded values (all columns, so any
projection too) stay below ``courtside.broadcast.maxBytes``.  The
aggregation is skipped, and the answer is no, where Catalyst's size
estimate is beyond that bound already.  The measure is kept per frame, so a
dimension used in several lookups is measured once.  Dimensions are
materialized (Parquet) before they are looked up, so this reads files, not
the plan that built them.  Beyond the bound the join is left to Spark
(sort-merge or shuffle-hash).  Joins between intermediate results are not
hinted at all: AQE replans them from measured shuffle sizes at run time.
"""

from __future__ import annotations

import weakref
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default row bound for broadcasting a lookup side; override with the
# session setting ``courtside.broadcast.maxRows``.
BROADCAST_MAX_ROWS = 1_000_000
# Bound on the decoded size (``courtside.broadcast.maxBytes``).
BROADCAST_MAX_BYTES = 128 << 20
# Bytes counted per value besides a text's own.
VALUE_BYTES = 16


def broadcast_bound(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("courtside.broadcast.maxRows", str(BROADCAST_MAX_ROWS)))


# Frame -> (rows, decoded bytes); entries go with their frames.
_MEASURED: weakref.WeakKeyDictionary[DataFrame, tuple[int, int]] = weakref.WeakKeyDictionary()


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate (file size for scans; an upper bound above joins/aggregates)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and decoded bytes of ``df``: one aggregation with partial sums, kept per frame."""
    got = _MEASURED.get(df)
    if got is None:
        width = F.lit(VALUE_BYTES * len(df.columns)).cast("bigint")
        for c, t in df.dtypes:
            if t in ("string", "binary"):
                width = width + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0))
        row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
        got = _MEASURED[df] = (row[0], row[1])
    return got


def fits_broadcast(df: DataFrame, max_rows: int, bounded_by: DataFrame | None = None) -> bool:
    """Proof that ``df`` has at most ``max_rows`` rows and a decoded size within bounds.

    ``bounded_by``: the table whose estimate stands for ``df``'s, where ``df``
    joins it with unique keys (Catalyst multiplies the sides of a join).
    """
    max_bytes = int(df.sparkSession.conf.get("courtside.broadcast.maxBytes", str(BROADCAST_MAX_BYTES)))
    if estimated_bytes(df if bounded_by is None else bounded_by) > max_bytes:
        return False
    rows, size = measured(df)
    return rows <= max_rows and size <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` is provably small (see ``fits_broadcast``), else ``df``."""
    bound = broadcast_bound(df) if max_rows is None else max_rows
    return F.broadcast(df) if fits_broadcast(df, bound) else df


def lookup(left: DataFrame, dim: DataFrame, left_keys: Sequence[str], dim_keys: Sequence[str],
           take: Sequence[str], how: str = "left", null_safe: bool = False,
           max_rows: int | None = None, rename: dict | None = None) -> DataFrame:
    """Join ``dim`` to ``left`` on ``left_keys == dim_keys`` and append ``take`` columns.

    Only the key and ``take`` columns of ``dim`` are read (column pruning
    reaches its scan); ``rename`` maps taken names to output names.
    """
    rename = rename or {}
    kcols = [f"_k{i}" for i in range(len(dim_keys))]
    bound = broadcast_bound(dim) if max_rows is None else max_rows
    small = fits_broadcast(dim, bound)
    side = dim.select(*[F.col(k).alias(a) for k, a in zip(dim_keys, kcols)],
                      *[F.col(t).alias(rename.get(t, t)) for t in take])
    side = F.broadcast(side) if small else side
    conds = [(left[lk].eqNullSafe(side[a]) if null_safe else left[lk] == side[a])
             for lk, a in zip(left_keys, kcols)]
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    return left.join(side, cond, how).drop(*kcols)
