r"""Quality rules with risk-controlled thresholds, DataFrame functions only.

Every text gets its counts in one projection.  Base rules reject short and
repetitive texts.  Beyond them, each metric (larger is worse) may reject a
text of a stratum (by default its language) above a cutoff.  Cutoffs come
from labelled documents: for each stratum and metric a fixed grid of cutoffs
is tested from the most lenient to the strictest.  A cutoff is certified
when the exact binomial tail P(X <= k | n, alpha) of its k false rejections
among n good labelled documents is at most delta / m.  Testing stops at the
first cutoff that is not certified (a fixed sequence needs no correction
along the grid), and m, the number of (stratum, metric) pairs, is the
Bonferroni correction over the rest.  ``alpha`` is the limit for a whole
stratum: each metric gets an equal share of it.  So with probability
1 - delta no stratum loses more than ``alpha`` of its good documents.  Of
the certified cutoffs the one with the most true minus false rejections is
used, of equal ones the most lenient; without any gain the metric is not
used in that stratum, as when a stratum has too few labels to certify.

The counts are written to the shared folder once; thresholds (one row per
stratum) are aggregated from them and joined back.

Defined results: a null or empty text has no words and fails the base rule;
a null stratum is one of its own; null labels and labels of unknown
documents are ignored, a document labelled both ways counts for neither.
Rows are judged one by one (repeated rows repeat); an empty table gives an
empty result.  Other columns are kept by ``keep_good`` under any name and ignored
by ``verdicts``.  A 5-word window is known by its 64-bit hash within one text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import WORD, by_position
from courtside.operators.materialize import materialize

SYMBOLS = r"[#*$%&|<>]"
SHARES = (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)
#: Metric -> grid of cutoffs, most lenient first.
GRID = {
    "symbols_per_word": (5.0, 3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.3, 0.2, 0.1, 0.05),
    "punctuation_share": SHARES,
    "capital_share": SHARES,
    "dup_line_share": SHARES,
    "repeat_share": SHARES,
    "mean_word_chars": (40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0),
}
_F = "_q_"


def _repeat_words(sorted_hashes: Column) -> Column:
    """Word positions covered by windows whose hash occurs twice; input: (hash, position) pairs, sorted."""
    twice = F.filter(sorted_hashes, lambda x, i: (
        ((i > 0) & (F.get(sorted_hashes, i - 1)["h"] == x["h"]))
        | ((i < F.size(sorted_hashes) - 1) & (F.get(sorted_hashes, i + 1)["h"] == x["h"]))))
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(starts, zero, lambda acc, i: F.struct(
        (i + 5).alias("end"), (acc["n"] + 5 - F.greatest(F.lit(0), acc["end"] - i)).alias("n")), lambda acc: acc["n"])


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every column, plus one struct column ``_q_`` with the counts of the text."""
    cols = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    a = docs.select(*cols, F.regexp_extract_all(text, F.lit(WORD), 0).alias(f"{_F}w"))
    w, n = F.col(f"{_F}w"), F.size(f"{_F}w")
    # Each of these columns is used several times below, so Catalyst keeps the steps apart.
    b = a.select(*cols, w, F.when(n >= 5, F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(
        *[F.get(w, i + j) for j in range(5)]))).alias(f"{_F}h"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)).alias(f"{_F}l"))
    h, lines = F.col(f"{_F}h"), F.col(f"{_F}l")
    c = b.select(*cols, w, lines, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(
        h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias(f"{_F}s"))
    s = F.col(f"{_F}s")
    d = c.select(*cols, F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda acc, x: acc + F.length(x)).alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.when(s.isNull(), F.lit(0)).otherwise(_repeat_words(s)).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s]")).cast("long").alias("n_punctuation"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals")).alias(_F))
    return d


def _metrics() -> dict[str, Column]:
    def share(a, b):
        return F.when(F.col(f"{_F}.{b}") > 0, F.col(f"{_F}.{a}") / F.col(f"{_F}.{b}")).otherwise(F.lit(0.0))

    return {"symbols_per_word": share("n_symbols", "n_words"), "punctuation_share": share("n_punctuation", "word_chars"),
            "capital_share": share("n_capitals", "word_chars"), "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"), "mean_word_chars": share("word_chars", "n_words")}


def base_failed() -> Column:
    return (F.col(f"{_F}.n_words") < 10) | (100 * F.col(f"{_F}.n_repeat_words") > 20 * F.col(f"{_F}.n_words"))


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series after shifting x by 8 (error below 1e-11)."""
    z = x + 8
    shift = sum((F.log(x + i) for i in range(8)), F.lit(0.0))
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5.0)))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), exact: the largest term by log-gamma, the others by their ratios.

    Terms shrink downwards from min(k, mode) as a Gaussian of width sqrt(n p) or faster;
    12 sqrt(n) + 64 terms lose less than 1e-30 of the sum.  k beyond the mode gives 1, above any level in use.
    """
    k, n = k.cast("double"), n.cast("double")
    log_top = (log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    steps = F.sequence(F.lit(0).cast("long"), F.least(k, 64 + 12 * F.sqrt(n)).cast("long"))
    zero = F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s"))
    total = F.aggregate(steps, zero, lambda acc, j: F.struct(
        (acc["t"] * (k - j) / (n - k + j + 1) * ((1 - p) / p)).alias("t"), (acc["s"] + acc["t"]).alias("s")), lambda acc: acc["s"])
    return F.when(n <= 0, F.lit(1.0)).when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(log_top) * total))


def thresholds(measured: DataFrame, labels: DataFrame, id_col: str, stratum: Column, alpha: float, delta: float) -> DataFrame:
    """One row per stratum (``_stratum``) with a cutoff per metric, null where the metric isn't used."""
    good = (labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
            .groupBy(F.col(id_col).cast("long").alias("_label_id"))
            .agg(F.min("quality").alias("_lo"), F.max("quality").alias("_hi"))
            .where(F.col("_lo") == F.col("_hi")).select("_label_id", (F.col("_hi") > 0).alias("_good")))
    rows = (measured.where(~base_failed())
            .select(F.col(id_col).cast("long").alias("_label_id"), stratum.alias("_stratum"), *[m.alias(f"_m_{k}") for k, m in _metrics().items()])
            .join(good, "_label_id"))
    cells = [(m, i, c) for m, grid in GRID.items() for i, c in enumerate(grid)]

    def rejected(m, c, good_ones):
        return F.count_if((F.col(f"_m_{m}") > c) & (F.col("_good") == good_ones))

    counted = rows.groupBy("_stratum").agg(
        F.count_if("_good").alias("n_good"),
        F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"),
                           rejected(m, c, True).alias("false_rejects"), rejected(m, c, False).alias("true_rejects"))
                  for m, i, c in cells]).alias("cells"))
    # From here on: one row per stratum, metric and cutoff.
    counted = materialize(counted, "quality-counts")
    pairs = F.lit(float(len(GRID))) * F.greatest(F.lit(1), counted.select(F.count(F.lit(1))).scalar())
    each = counted.select("_stratum", "n_good", F.inline("cells"))
    tested = each.withColumn("certified", binomial_tail(F.col("false_rejects"), F.col("n_good"), alpha / len(GRID)) <= delta / pairs)
    stop = F.min(F.when(~F.col("certified"), F.col("step")))
    first_bad = tested.groupBy("_stratum", "metric").agg(
        stop.alias("stop"), F.collect_list(F.struct((F.col("true_rejects") - F.col("false_rejects")).alias("gain"),
                                                    (-F.col("step")).alias("lenient"), "cutoff", "step")).alias("all"))
    best = F.array_max(F.filter("all", lambda x: (x["gain"] > 0) & (x["step"] < F.coalesce(F.col("stop"), F.lit(1 << 20)))))
    chosen = first_bad.select("_stratum", "metric", best["cutoff"].alias("cutoff"))
    return chosen.groupBy("_stratum").pivot("metric", list(GRID)).agg(F.first("cutoff"))


def assess(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang",
           keep: list[str] | None = None, alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """``keep`` columns (default: all) plus ``_q_`` (counts), ``_base_failed`` and ``_kept`` for every row."""
    names = docs.columns if keep is None else keep
    needed = list(dict.fromkeys([*names, id_col, *([stratum_col] if stratum_col else [])]))
    measured = measure(docs.select(*dict.fromkeys([*needed, text_col])), text_col).select(*needed, _F)
    measured = materialize(measured, "quality")
    # A prefix keeps a null stratum apart from any text.
    stratum = F.coalesce(F.concat(F.lit("="), F.col(stratum_col).cast("string")), F.lit("null")) if stratum_col else F.lit("all")
    bars = thresholds(measured, labels, id_col, stratum, alpha, delta)
    bars = bars.select(F.col("_stratum").alias("_q_stratum"), *[F.col(m).alias(f"_q_bar_{m}") for m in GRID])
    too_high = F.lit(False)
    for m, value in _metrics().items():
        too_high = too_high | F.coalesce(value > F.col(f"_q_bar_{m}"), F.lit(False))
    joined = measured.join(bars, stratum == F.col("_q_stratum"), "left")
    return joined.select(*names, _F, base_failed().alias("_base_failed"), (~base_failed() & ~too_high).alias("_kept"))


def verdicts(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The contract's columns, then the further counts."""
    id_col = options.get("id_col", "doc_id")
    out = assess(docs, labels, keep=[id_col], **options)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select(id_col, *[F.col(f"{_F}.{c}").alias(c) for c in names], F.col("_base_failed").alias("base_failed"),
                      F.col("_kept").alias("kept"), F.col(f"{_F}.n_punctuation").alias("n_punctuation"),
                      F.col(f"{_F}.n_capitals").alias("n_capitals"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang",
              **options) -> DataFrame:
    """The rows that pass, with their own columns only, whatever these are called."""
    plain, name = by_position(docs)
    known = labels.select(F.col(id_col).alias(name[id_col]), "quality")
    passed = assess(plain, known, name[id_col], name[text_col], name[stratum_col] if stratum_col else None, **options).where("_kept")
    return passed.select(*plain.columns).toDF(*docs.columns)
