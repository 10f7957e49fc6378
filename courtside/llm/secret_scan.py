r"""Secret scan with DataFrame functions only (no Python on the rows).

Base patterns (kinds ``assign``, ``access``, ``hex``) are matched leftmost
and without overlap.  Positions come from the text between matches:
``split`` and ``regexp_extract_all`` with one pattern give the gaps and the
hits, and a fold over their lengths gives (start, end) in code points.

The method adds the kind ``entropy``: each candidate string (20 or more of
``[A-Za-z0-9+/_=-]``) belongs to a character class (digits, hex, letters,
alnum, base64).  A window of ``WINDOW`` characters slides over it; the fold
keeps a count per character and the running sum of c*log2(c), both changed
only for the character that enters and the one that leaves, so the entropy
of every window is exact at constant cost.  The candidate is a secret when
some window without a placeholder word reaches its class's threshold and the
candidate is neither a UUID nor words joined by separators.  Joined words
have a separator, their parts are written as words are, and none reaches the
threshold of letters alone; so a key of letters, alone or as a part, counts.
A candidate inside a base span adds nothing; base spans always stay.

Defined results: a null or empty text has no spans (count 0, the digest of
the empty string).  Rows are scanned one by one: repeated rows repeat, ties
in start are listed in the order of kinds, an empty table gives an empty
result; other columns are kept by ``redact`` and ignored by ``scan``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import by_position

#: Fixed values of the contract.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # as AKIA[A-Z0-9]+ with 20 or more characters: both take the whole run
HEX = r"[0-9a-f]{24,}"  # as [0-9a-f]+ with 24 or more characters
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Bits a window must reach, by class; 20 characters have at most 4.32.  Digits alone are never secrets.
THRESHOLDS = {"hex": 3.0, "letters": 4.2, "alnum": 3.7, "base64": 3.9}
#: A part in one case, capitalised or in camel case with humps of two small letters or more.
_PART = "(?:[A-Z]*[a-z]{2,}(?:[A-Z]+[a-z]{2,})*+[A-Z]*|[A-Z]+|[A-Z]?[a-z])(?![A-Za-z])"
JOINED = rf"^(?=[A-Za-z]*[/_=+-])/?{_PART}(?:[/_=+-]+{_PART})*+[/_=+-]*$"  # words joined by separators
ALLOW = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    JOINED,
)
#: A window that meets one of these does not count; the rest of the candidate does.
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|xxxx|0123456789|abcdefghijklm"

#: A candidate written like this is itself a base span of kind ``hex`` or ``access``: both take whole runs.
BASE_RUN = r"^(?:[0-9a-f]{24,}|AKIA[A-Z0-9]{16,})$"

_SPAN = "array<struct<s:int,k:int,e:int>>"
_HIT = "array<struct<s:int,k:int,e:int,hit:string>>"
_BLOCK = 256  # hits a fold appends to one array


def _none(kind: str = _SPAN) -> Column:
    return F.array().cast(kind)


def _spans(hits: Column, gaps: Column, kind: int, keep, with_hit: bool = False) -> Column:
    """(start, kind, end) of the hits for which ``keep(hit)`` holds, in blocks; ``with_hit``: and the hit."""
    shape = _HIT if with_hit else _SPAN

    def step(acc, i):
        start = acc["at"] + F.length(F.get(gaps, i))
        hit = F.get(hits, i)
        end = start + F.length(hit)
        one = F.array(F.struct(start.alias("s"), F.lit(kind).alias("k"), end.alias("e"), *[hit.alias("hit")] * with_hit)).cast(shape)
        return F.struct(end.alias("at"), F.when(keep(hit), F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    def block(acc, b):
        zero = F.struct(acc["at"].alias("at"), _none(shape).alias("out"))
        done = F.aggregate(F.sequence(b, F.least(b + _BLOCK, F.size(hits)) - 1), zero, step)
        # One element, so that the inner fold runs once.
        return F.get(F.transform(F.array(done), lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], F.array(d["out"])).alias("out"))), F.lit(0))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{shape}>").alias("out"))
    blocks = F.sequence(F.lit(0), F.size(hits) - 1, F.lit(_BLOCK))
    return F.flatten(F.aggregate(blocks, zero, block, lambda acc: acc["out"]))


def _outside(found: Column, base: Column) -> Column:
    """The candidates that lie in no span of ``base`` (spans of one kind, so without overlap): one pass over both in order of start."""
    both = F.sort_array(F.concat(F.transform(base, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), F.lit("").alias("hit"))), found))
    ends = F.transform(both, lambda x: F.when(x["k"] < 3, x["e"]))
    # The base span a candidate may lie in is the last one that starts before it: the one seen last.
    zero = F.struct(F.lit(-1).alias("end"), _none("array<array<int>>").alias("out"), _none("array<int>").alias("part"))

    def step(acc, e):
        end = F.coalesce(e, acc["end"])
        full = F.size(acc["part"]) >= _BLOCK
        return F.struct(end.alias("end"), F.when(full, F.concat(acc["out"], F.array(acc["part"]))).otherwise(acc["out"]).alias("out"),
                        F.when(full, F.array(end)).otherwise(F.concat(acc["part"], F.array(end))).alias("part"))

    last = F.aggregate(ends, zero, step, lambda acc: F.flatten(F.concat(acc["out"], F.array(acc["part"]))))
    pairs = F.arrays_zip(both.alias("x"), last.alias("end"))
    return F.transform(F.filter(pairs, lambda p: (p["x"]["k"] == 3) & (p["x"]["e"] > p["end"])), lambda p: p["x"])


#: The characters of candidates lie in ``+`` .. ``z``; a count of at most 31 takes 5 bits, 12 of them a long.
_FIRST, _PER, _LONGS = ord("+"), 12, 7


def window_entropy(s: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy (bits) of the windows of a candidate's characters, by incremental counts; 0 if shorter.

    The counts of a window (at most 31 long) are packed in seven longs.
    """
    if not 0 < window < 32:
        raise ValueError(f"window {window}")
    codes = F.transform(F.split(s, ""), lambda c: F.ascii(c) - _FIRST)
    kind = "struct<codes:array<int>,n:array<bigint>,sum:double,best:double>"
    # c * log2(c) for the counts 0 to window + 1.
    table = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    zero = F.struct(codes.alias("codes"), F.array_repeat(F.lit(0).cast("bigint"), _LONGS).alias("n"), F.lit(0.0).alias("sum"),
                    F.lit(float(window) * 64).alias("best")).cast(kind)

    def slot(c):
        return (c / _PER).cast("int")

    def count(n, c):
        return F.call_function("shiftright", F.get(n, slot(c)), c % _PER * 5).bitwiseAND(F.lit(31)).cast("int")

    def unit(c, j):
        return F.when(slot(c) == j, F.call_function("shiftleft", F.lit(1).cast("bigint"), c % _PER * 5)).otherwise(F.lit(0).cast("bigint"))

    def more(c):
        return F.get(table, c + 1) - F.get(table, c)

    def enter(acc, i):
        new = F.get(acc["codes"], i)
        return F.struct(acc["codes"].alias("codes"), F.transform(acc["n"], lambda x, j: x + unit(new, j)).alias("n"),
                        (acc["sum"] + more(count(acc["n"], new))).alias("sum"), acc["best"].alias("best")).cast(kind)

    def slide(acc, i):
        new, old = F.get(acc["codes"], i), F.get(acc["codes"], i - window)
        total = F.when(new == old, acc["sum"]).otherwise(acc["sum"] + more(count(acc["n"], new)) - more(count(acc["n"], old) - 1))
        counts = F.when(new == old, acc["n"]).otherwise(F.transform(acc["n"], lambda x, j: x + unit(new, j) - unit(old, j)))
        return F.struct(acc["codes"].alias("codes"), counts.alias("n"), total.alias("sum"),
                        F.least(acc["best"], total).alias("best")).cast(kind)

    filled = F.aggregate(F.sequence(F.lit(0), F.lit(window - 1)), zero, enter,
                         lambda acc: F.struct(acc["codes"].alias("codes"), acc["n"].alias("n"), acc["sum"].alias("sum"),
                                              acc["sum"].alias("best")).cast(kind))
    rest = F.when(F.length(s) > window, F.sequence(F.lit(window), F.length(s) - 1)).otherwise(F.array().cast("array<int>"))
    bits = F.aggregate(rest, filled, slide, lambda acc: F.lit(1.0) * F.log2(F.lit(float(window))) - acc["best"] / window)
    return F.when(F.length(s) >= window, bits).otherwise(F.lit(0.0))


def _is_secret(s: Column) -> Column:
    bits = F.array_max(F.transform(F.split(s, PLACEHOLDER, -1), lambda p: window_entropy(p)))
    bar = (F.when(s.rlike("^[0-9a-fA-F]+$"), F.lit(THRESHOLDS["hex"]))
           .when(s.rlike("^[A-Za-z]+$"), F.lit(THRESHOLDS["letters"]))
           .when(s.rlike("^[A-Za-z0-9]+$"), F.lit(THRESHOLDS["alnum"])).otherwise(F.lit(THRESHOLDS["base64"])))
    key_part = F.exists(F.split(s, "[/_=+-]+", -1), lambda p: window_entropy(p) >= THRESHOLDS["letters"])
    allowed = s.rlike("^[0-9]+$")
    for pattern in ALLOW:
        allowed = allowed | (s.rlike(pattern) & ~key_part if pattern == JOINED else s.rlike(pattern))
    return F.when(allowed, F.lit(False)).otherwise(bits >= bar)


def with_spans(docs: DataFrame, text_col: str = "text", out: str = "_spans") -> DataFrame:
    """Every column, plus ``out``: array of (s, k, e) by start and kind; k indexes ``KINDS``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    plans = (("assign", ASSIGN, lambda h: F.length(F.regexp_extract(h, ASSIGN, 2)) >= 6),
             ("access", ACCESS, lambda h: F.lit(True)), ("hex", HEX, lambda h: F.lit(True)), ("entropy", CANDIDATE, lambda h: ~h.rlike(BASE_RUN)))
    cols = docs.columns
    # One scan a pattern; the gaps are cut only in rows with a hit.
    hits = docs.select(*cols, *[F.regexp_extract_all(text, F.lit(p), 0).alias(f"{out}_h_{k}") for k, p, _ in plans])
    both = hits.select("*", *[F.when(F.size(f"{out}_h_{k}") > 0, F.split(text, p, -1)).alias(f"{out}_g_{k}") for k, p, _ in plans])
    spans = both.select(*cols, *[F.when(F.size(f"{out}_h_{k}") > 0, _spans(F.col(f"{out}_h_{k}"), F.col(f"{out}_g_{k}"), i, keep, k == "entropy"))
                                 .otherwise(_none(_HIT if k == "entropy" else _SPAN)).alias(f"{out}_{k}") for i, (k, _, keep) in enumerate(plans)])
    # Entropies are computed only of candidates outside the base spans.
    assign, entropy = F.col(f"{out}_assign"), F.col(f"{out}_entropy")
    free = F.when((F.size(assign) > 0) & (F.size(entropy) > 0), _outside(entropy, assign)).otherwise(entropy)
    secret = F.transform(F.filter(free, lambda x: _is_secret(x["hit"])), lambda x: F.struct(x["s"], x["k"], x["e"])).cast(_SPAN)
    return spans.select(*cols, F.sort_array(F.concat(*[F.col(f"{out}_{k}") for k in KINDS[:3]], secret)).alias(out))


def _listed(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["k"]), x["s"].cast("string"), x["e"].cast("string"))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts per base kind, digest of the base spans, all spans as text."""
    found = with_spans(docs.select(F.col(id_col), F.col(text_col)), text_col)
    base = F.filter("_spans", lambda x: x["k"] < 3)

    def count(k):
        return F.size(F.filter("_spans", lambda x: x["k"] == k)).cast("long")

    return found.select(F.col(id_col), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("_spans")).alias("spans"),
                        count(3).alias("n_entropy"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns, each found span replaced by ``[kind]``; overlapping spans become one.

    ``length_col``, if present, gets the new number of code points.  A null text stays null.
    """
    plain, place = by_position(docs)
    found = with_spans(plain, place[text_col], "_spans__")
    name = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    text = F.col(place[text_col])
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        cut = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.get(name, x["k"]))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(x["s"] >= acc["at"], cut).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("_spans__", zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    new = found.select(*plain.columns, F.when(F.size("_spans__") > 0, done).otherwise(text).alias("_redacted__"))
    as_is = {place[text_col]: F.col("_redacted__").alias(place[text_col])}
    if length_col in place:
        length = place[length_col]
        as_is[length] = F.when(text.eqNullSafe(F.col("_redacted__")), F.col(length)).otherwise(
            F.length("_redacted__")).cast(dict(docs.dtypes)[length_col]).alias(length)
    return new.select(*[as_is.get(c, F.col(c)) for c in plain.columns]).toDF(*docs.columns)
