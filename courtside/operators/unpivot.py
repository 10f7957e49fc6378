"""Unpivot role groups (player slots, home/visitor columns) in one pass.

``inline(array(struct ...))`` turns N column groups into N rows per input
row inside one Generate operator: one scan instead of N selects + union.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_groups(df: DataFrame, keep: Sequence[str], groups: Sequence[Mapping[str, str | None]],
                   role_col: str | None = None) -> DataFrame:
    """Each group maps output name -> input column (or None for NULL).

    All groups must name the same outputs.  With ``role_col`` the 1-based
    group number is added.
    """
    names = list(groups[0].keys())
    structs = []
    for i, g in enumerate(groups, start=1):
        fields = [(F.col(g[n]) if g[n] is not None else F.lit(None)).alias(n) for n in names]
        if role_col:
            fields = [F.lit(i).alias(role_col)] + fields
        structs.append(F.struct(*fields))
    return df.select(*keep, F.inline(F.array(*structs)))


def stack_columns(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """``stack(n, c1, ..., cn) AS out``: one column of all values, NULLs kept."""
    return df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(out))
