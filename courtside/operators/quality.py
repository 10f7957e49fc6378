"""Data-quality checks re-aimed from relational constraints.

Each returns a DataFrame of violations (empty = check passed), computed
distributively: keys are grouped with partial aggregation, references are
checked with a left-anti join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dq_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row: (keys..., n)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def dq_foreign_key(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
                   parent_keys: Sequence[str]) -> DataFrame:
    """Child rows with a non-NULL key missing from the parent."""
    p = parent.select(*[F.col(k).alias(f"_p{i}") for i, k in enumerate(parent_keys)]).distinct()
    cond = None
    for i, k in enumerate(child_keys):
        c = child[k] == p[f"_p{i}"]
        cond = c if cond is None else cond & c
    known = F.col(child_keys[0]).isNotNull()
    for k in child_keys[1:]:
        known = known & F.col(k).isNotNull()
    present = child.where(known)
    return present.join(p, cond, "left_anti")


def dq_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the number of NULLs per column (``nulls_<col>``) in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns])


def dq_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """(columna, limite, excedidos): rows whose text is longer than the column limit."""
    counts = df.agg(*[F.count_if(F.length(F.col(c)) > n).alias(c) for c, n in limits.items()])
    stack = ", ".join(f"'{c}', {n}, `{c}`" for c, n in limits.items())
    return counts.selectExpr(f"stack({len(limits)}, {stack}) AS (columna, limite, excedidos)")
