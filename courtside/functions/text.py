"""Text normalisation helpers (native expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The season-type alias folded into one spelling.
SEASON_ALIASES = {"All Star": "All-Star"}
UNKNOWN = "Desconocido"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_key(c) -> Column:
    """Join key form of a name: ``lower(trim(x))``."""
    return F.lower(F.trim(_c(c)))


def full_name(*parts) -> Column:
    """Space-joined name; NULL parts are skipped, all-NULL gives ''."""
    return F.concat_ws(" ", *[_c(p) for p in parts])


def season_type(c) -> Column:
    out = _c(c)
    for alias, canonical in SEASON_ALIASES.items():
        out = F.when(out == F.lit(alias), F.lit(canonical)).otherwise(out)
    return out


def to_number(c) -> Column:
    """ANSI-safe numeric reading of text ('18422.0', 'Desconocido', '')."""
    return _c(c).try_cast("double")
