"""Play-text cleaning as native expressions (no Python UDF, no driver-side regex).

Dictionary removal (player-name fragments, team nicknames) works on runs:
a text is split into maximal alternating word / non-word runs, and a
whole-word match ``\\bF\\b`` of a dictionary entry F is exactly a sequence of
consecutive runs whose concatenation equals F (plus: an entry that starts
(ends) with a non-word character needs a run before (after) it).  Run
n-grams are semi-joined with the dictionary, the leftmost (then longest)
non-overlapping matches are chosen with an ``aggregate`` fold, and the
remaining runs are joined back.  Everything else is ``regexp_replace``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.operators.lookup import broadcast_bound, checked_broadcast, fits_broadcast
from courtside.operators.materialize import materialize

# Word characters, boundaries, digits and spaces are Unicode ones, as in the source job's patterns.
UNICODE = "(?U)"
RUN_PATTERN = UNICODE + r"\w+|\W+"

# Patterns removed in the same scan as the dictionary
# (parenthesised text, shot distance, initial, short abbreviation, "N of M").
FIXED_REMOVALS = [r"\([^)]*\)", r"\b\d{1,3}'", r"\b[A-Z]\.", r"\b[A-Za-z]{2,5}\.", r"\b\d+ of \d+\b"]

# Tidy-up steps applied in order (pattern, replacement).
TIDY_STEPS = [
    (r'[",]+', ""),
    (r"\s*[-–—]+\s*", " "),
    (r"^\W+|\W+$", ""),
    (r"\b\d+' ?", ""),
    (r"\s*[\.,:;]+\s*", " "),
    (r"\s+", " "),
]

# Alias words removed afterwards, one whole-word pass each, in order.
ALIAS_WORDS = ["N'Dong", "Yuezhuo", "zhi", "Tompkins", "McClellan", "Renfroe", "Kanter", "Lima",
               "Seung", "Jin", "Pendergraph", "McKinney", "Yue", "Arna", "Hersek", "McLean",
               "N'Diaye", "Maciulis", "McRay", "Yurtseven", "Llull"]

# Play-style words and phrases removed afterwards, in order.
STYLE_WORDS = ["Running", "Driving", "Pullup", "Step Back", "Fadeaway", "Floating", "Putback",
               "Reverse", "Cutting", "Follow Up", "Bank", "Alley Oop",
               "Turnaround", "Hook", "Tip", "Jumper"]


def runs(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(RUN_PATTERN), 0)


def name_parts(c: Column) -> Column:
    """The whitespace-separated parts of a name (case kept)."""
    return F.filter(F.split(c, UNICODE + r"\s+"), lambda p: p != "")


def split_hot_grams(grams: DataFrame, names: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(grams that at most ``hot_rows`` rows share, the others, the entries among the others).

    A gram such as a word of nearly every text would put all its rows into one
    task of a join by gram.  Such grams are few (the rows over ``hot_rows`` at
    most) and are found by a count with partial sums.
    """
    hot = grams.groupBy(F.col("_g.g").alias("_h")).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > hot_rows).select("_h")
    hot = materialize(hot.where("_h IS NOT NULL"), "hot-grams")
    side = checked_broadcast(hot)
    return (grams.join(side, F.col("_g.g") == F.col("_h"), "left_anti"), grams.join(side, F.col("_g.g") == F.col("_h"), "left_semi"),
            names.join(side, F.col("_e") == F.col("_h"), "left_semi"))


def large_dictionary_matches(grams: DataFrame, names: DataFrame, hot_rows: int) -> DataFrame:
    """The grams that are dictionary entries (text, ``_g``, ``_e``), for a dictionary beyond the broadcast bound.

    Hot grams meet the few entries among them by broadcast, the others the
    dictionary by a shuffle in which no key has more than ``hot_rows`` rows.
    """
    cold, hot, few = split_hot_grams(grams.drop("_n"), names, hot_rows)
    return cold.join(names, F.col("_g.g") == F.col("_e")).unionByName(hot.join(checked_broadcast(few), F.col("_g.g") == F.col("_e")))


def remove_entries(texts: DataFrame, text_col: str, dictionary: DataFrame, out_col: str, hot_rows: int = 1_000_000) -> DataFrame:
    """Add ``out_col`` = ``text_col`` with every whole-word dictionary entry removed.

    ``texts`` must have distinct ``text_col`` values; ``dictionary`` has one
    column ``entry``.  The longest entry (in runs) bounds the n-gram length;
    it is one aggregated number.  ``hot_rows``: see ``large_dictionary_matches``.
    """
    entries = dictionary.select("entry").where(F.col("entry").isNotNull() & (F.col("entry") != "")).distinct()
    # Small, read three times (summary, size check, join): materialized once.
    entries = materialize(entries.select("entry", F.size(runs(F.col("entry"))).alias("k")), "dictionary")
    # One row about the dictionary: longest entry (in runs), whether any entry
    # starts / ends with a non-word character, and the entry lengths.
    summary = entries.agg(F.max("k"), F.max(F.when(~F.col("entry").rlike(UNICODE + r"^\w"), 1).otherwise(0)),
                          F.max(F.when(~F.col("entry").rlike(UNICODE + r"\w$"), 1).otherwise(0)), F.collect_set("k")).first()
    kmax, odd_start, odd_end = (summary[0] or 0), bool(summary[1]), bool(summary[2])
    t = texts.select(text_col, runs(F.col(text_col)).alias("_runs"))
    if kmax == 0:
        return texts.withColumn(out_col, F.col(text_col))
    n = F.size("_runs")
    # Runs alternate word / non-word: when every entry starts and ends with
    # a word character, matches start on word runs and span an odd number
    # of runs, so other n-grams are not generated.
    word_first = F.col("_runs")[0].rlike(UNICODE + r"^\w")
    ks = sorted(summary[3])  # only the lengths that entries have

    def starts(k: int):
        every = F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))
        if odd_start or odd_end:
            return every
        first = F.when(word_first, F.lit(0)).otherwise(F.lit(1))
        return F.when(n - k >= first, F.sequence(first, n - k, F.lit(2))).otherwise(F.array().cast("array<int>"))

    def gram_at(k: int):
        # one-argument lambda: a second parameter would receive the element index
        return lambda p: F.struct(p.alias("p"), F.lit(k).alias("k"),
                                  F.array_join(F.slice("_runs", p + 1, F.lit(k)), "").alias("g"))

    grams = t.select(
        text_col, n.alias("_n"),
        F.explode_outer(F.flatten(F.array(*[F.transform(starts(k), gram_at(k)) for k in ks]))).alias("_g"))
    ok = ((F.col("_e").rlike(UNICODE + r"^\w") | (F.col("_g.p") > 0))
          & (F.col("_e").rlike(UNICODE + r"\w$") | (F.col("_g.p") + F.col("_g.k") < F.col("_n"))))
    names = entries.select(F.col("entry").alias("_e"))
    if fits_broadcast(names, broadcast_bound(names)):
        # Left join keeps texts without matches; the texts arrive partitioned by
        # text (they are distinct), so regrouping them needs no shuffle.
        met = grams.join(F.broadcast(names), F.col("_g.g") == F.col("_e"), "left")
    else:
        met = large_dictionary_matches(grams, names, hot_rows).join(t.select(text_col, n.alias("_n")), text_col, "right")
    found = (met.groupBy(text_col).agg(F.array_sort(F.collect_list(F.when(F.col("_e").isNotNull() & ok, F.struct(
        F.col("_g.p").alias("p"), (-F.col("_g.k")).alias("negk"))))).alias("_m")))
    # Leftmost, then longest, non-overlapping matches.
    init = F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("drop"))
    chosen = F.aggregate(
        F.col("_m"), init,
        lambda acc, m: F.when(m["p"] >= acc["end"], F.struct(
            (m["p"] - m["negk"]).alias("end"),
            F.concat(acc["drop"], F.sequence(m["p"], m["p"] - m["negk"] - 1)).alias("drop")))
        .otherwise(acc))
    picked = found.select(text_col, chosen["drop"].alias("_drop"))
    kept = F.filter(runs(F.col(text_col)), lambda r, i: ~F.array_contains(F.col("_drop"), i))
    return picked.select(text_col, F.array_join(kept, "").alias(out_col))


def tidy(c: Column) -> Column:
    """Fixed-pattern removal and the tidy-up steps; trims the result."""
    out = F.regexp_replace(c, UNICODE + "|".join(FIXED_REMOVALS), "")
    for pat, rep in TIDY_STEPS:
        out = F.regexp_replace(out, UNICODE + pat, rep)
    return F.trim(out)


def drop_words(c: Column, words) -> Column:
    for w in words:
        c = F.regexp_replace(c, UNICODE + r"\b" + w + r"\b", "")
    return c


def final_tidy(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, " +", " "))
