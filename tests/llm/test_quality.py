import re
from collections import Counter
from math import comb

from pyspark.sql import functions as F

from courtside.llm import quality as Q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def rows_of(df):
    return [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect()]


def test_counts_match_brute_force(spark, sf_small, odd_docs):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    extra = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c d e " * 9, "a b c d e f a b c d e g h i", "x\nx\n\n \n x\nx", "  a b # $ %", "q " * 40 + "\n" + "q " * 40])],
                                  "doc_id long, text string")
    for docs in (spark.read.parquet(f"{sf_small}/documents.parquet"), extra.withColumn("lang", F.lit("en")), odd_docs):
        got = rows_of(Q.verdicts(docs, labels))
        assert sorted(map(str, got)) == sorted(str((r.doc_id, *brute(r.text))) for r in docs.collect())


def test_binomial_tail_is_exact(spark):
    cases = [(k, n, p) for n in (1, 7, 50, 400, 3000) for p in (0.01, 0.05, 0.3) for k in (0, 1, n // 100, n // 40, n // 10) if k < n * p]
    for p in (0.01, 0.05, 0.3):
        mine = [(k, n) for k, n, q in cases if q == p]
        got = spark.createDataFrame(mine, "k long, n long").select("k", "n", Q.binomial_tail(F.col("k"), F.col("n"), p).alias("t")).collect()
        for r in got:
            want = sum(comb(r.n, j) * p**j * (1 - p)**(r.n - j) for j in range(r.k + 1)) if r.n < 1000 else None
            if want is not None:
                assert abs(r.t - want) < 1e-9 * max(want, 1e-300) + 1e-300


def labelled(spark, n_good, n_bad, lang="en"):
    good = " ".join(f"word{i}" for i in range(30))
    bad = " ".join(f"w{i}###" for i in range(30))
    docs = spark.range(n_good + n_bad).select(F.col("id").alias("doc_id"), F.when(F.col("id") < n_good, good).otherwise(bad).alias("text"), F.lit(lang).alias("lang"))
    labels = spark.range(n_good + n_bad).select(F.col("id").alias("doc_id"), (F.col("id") < n_good).cast("int").alias("quality"))
    return docs, labels


def test_cutoffs_need_enough_labels(spark):
    docs, labels = labelled(spark, 900, 60)
    kept = Q.verdicts(docs, labels).groupBy("kept").count().collect()
    assert {r.kept: r["count"] for r in kept} == {True: 900, False: 60}
    docs, labels = labelled(spark, 200, 60)  # too few to certify: nothing is rejected
    assert Q.verdicts(docs, labels).where("not kept").count() == 0
    assert Q.verdicts(docs, labels.limit(0)).where("not kept").count() == 0


def test_false_rejections_stay_limited(spark):
    docs, labels = labelled(spark, 2000, 500)
    noisy = labels.withColumn("quality", F.when(F.col("doc_id") % 3 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    out = Q.verdicts(docs, noisy).join(noisy, "doc_id").where("quality = 1")
    assert out.where("not kept").count() <= 0.05 * out.count()


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, None), (1, 0, 0), (None, 1, 1), (2, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    kept = Q.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and [r.doc_id for r in kept.collect()] == [4]
    assert Q.verdicts(no_docs, labels).count() == 0 and Q.keep_good(no_docs, labels.limit(0)).count() == 0
