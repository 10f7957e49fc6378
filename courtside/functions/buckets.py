"""Table-driven bucketing, unit conversion and code maps for the dimensions.

Rules are data: each bucket is (label, low, low_inclusive, high,
high_inclusive); values outside every bucket (gaps, NULL, <= 0) get the
default.  The bounds are the exact ones of the source rules, gaps included.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = None  # open upper bound

# Conversion factors.
POUND_KG = 0.45359237
INCH_M = 0.0254

# Bucket rules (label, low, low_incl, high, high_incl).
WEIGHT_KG = [
    ("Muy liviano", 0, False, 74.99, True),
    ("Liviano", 75, True, 94.99, True),
    ("Medio", 95, True, 119.99, True),
    ("Pesado", 120, True, 139.99, True),
    ("Muy Pesado", 140, True, INF, True),
]
HEIGHT_M = [
    ("Muy bajo", 0, False, 1.79, True),
    ("Bajo", 1.80, True, 1.89, True),
    ("Medio", 1.90, True, 2.04, True),
    ("Alto", 2.05, True, 2.14, True),
    ("Muy alto", 2.15, True, INF, True),
]
WINGSPAN_M = [
    ("Muy corta", 0, False, 1.89, True),
    ("Corta", 1.90, True, 2.04, True),
    ("Media", 2.05, True, 2.19, True),
    ("Larga", 2.20, True, 2.34, True),
    ("Muy larga", 2.35, True, INF, True),
]
REACH_M = [
    ("Muy bajo", 0, False, 2.34, True),
    ("Bajo", 2.35, True, 2.54, True),
    ("Medio", 2.55, True, 2.84, True),
    ("Alto", 2.85, True, 2.99, True),
    ("Muy alto", 3.0, True, INF, True),
]
CAREER_YEARS = [
    ("Novato", 0, True, 9, True),
    ("Consolidado", 10, True, 19, True),
    ("Veterano", 20, True, 29, True),
    ("Longevo", 30, True, INF, True),
]
# Arena capacity: below 10000 small, below 20000 medium, anything else
# (including unknown / unparseable) large.
CAPACITY = [
    ("pequeno", None, True, 10000, False),
    ("mediano", 10000, True, 20000, False),
]
CAPACITY_DEFAULT = "grande"
UNKNOWN = "Desconocido"

# Position code -> label; anything else (NULL, '') unknown.
POSITIONS = {
    "PG": "Base",
    "SG": "Escolta",
    "SF": "Alero",
    "PF": "Ala-pívot",
    "C": "Pívot",
    "PG-SG": "Base/Escolta",
    "SG-PG": "Escolta/Base",
    "SG-SF": "Escolta/Alero",
    "SF-SG": "Alero/Escolta",
    "SF-PF": "Alero/Ala-pívot",
    "PF-SF": "Ala-pívot/Alero",
    "PF-C": "Ala-pívot/Pívot",
    "C-PF": "Pívot/Ala-pívot",
    "Guard": "Escolta",
    "Forward": "Alero",
    "Center": "Pívot",
    "Guard-Forward": "Escolta/Alero",
    "Forward-Guard": "Alero/Escolta",
    "Center-Forward": "Pívot/Ala-pívot",
    "Forward-Center": "Alero/Pívot",
}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucketize(c, rules, default: str = UNKNOWN, half_open: bool = False) -> Column:
    """First matching rule wins; NULL and gaps fall to ``default``.

    ``half_open`` closes the gaps: each bucket ends where the next begins.
    """
    x = _c(c)
    out = None
    if half_open:
        rules = [(label, lo, lo_incl, after[1], False) if after else (label, lo, lo_incl, hi, hi_incl)
                 for (label, lo, lo_incl, hi, hi_incl), after in zip(rules, [*rules[1:], None])]
    for label, lo, lo_incl, hi, hi_incl in rules:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & ((x >= F.lit(lo)) if lo_incl else (x > F.lit(lo)))
        if hi is not None:
            cond = cond & ((x <= F.lit(hi)) if hi_incl else (x < F.lit(hi)))
        cond = x.isNotNull() & cond
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def position_label(c) -> Column:
    """Code -> label through a literal map (no join); unknown codes -> 'Desconocido'."""
    m = F.create_map(*[F.lit(x) for kv in POSITIONS.items() for x in kv])
    return F.coalesce(F.try_element_at(m, _c(c)), F.lit(UNKNOWN))


def capacity_bucket(number: Column) -> Column:
    return bucketize(number, CAPACITY, CAPACITY_DEFAULT)
