"""Dictionary removal on word/non-word runs vs. a brute-force single regex scan."""

import random
import re

import pytest
from pyspark.sql import functions as F

from courtside.functions import cleaning as C


def _brute(text, entries):
    alts = sorted(set(entries), key=lambda e: (-len(e), e))
    pat = re.compile(r"\b(?:" + "|".join(map(re.escape, alts)) + r")\b")
    return pat.sub("", text)


@pytest.mark.parametrize("extra", [[], ["Jr.", ".Net"]])
def test_remove_entries_matches_regex_scan(spark, extra):
    rnd = random.Random(7)
    words = ["Smith", "O'Neal", "Jr.", "Trail Blazers", "Ball", "Al", "Allen", "J.J.", "000042", "Van Horn", ".Net"]
    entries = ["Smith", "O'Neal", "Ball", "Al", "Allen", "Trail Blazers", "000042", "Van", "Horn", "J.J"] + extra
    filler = ["MISS", "3PT", "Jump", "Shot", "(2 PTS)", "vs.", ":", "-", "BLOCK", "Layup", "'s", "Ball's", "Jr.X"]
    texts = set()
    for _ in range(300):
        toks = [rnd.choice(words + filler) for _ in range(rnd.randint(1, 9))]
        seps = [rnd.choice([" ", "  ", "", ", ", ": "]) for _ in toks]
        texts.add("".join(t + s for t, s in zip(toks, seps)))
    texts = sorted(texts)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    d = spark.createDataFrame([(e,) for e in entries], "entry string")
    got = {r["t"]: r["s"] for r in C.remove_entries(df, "t", d, "s").collect()}
    for t in texts:
        assert got[t] == _brute(t, entries), t


def test_tidy_and_words(spark):
    rows = [("  24' 3PT Jump Shot (3 PTS) (  1 AST)", "3PT Jump Shot"),
            ("MISS  5' Dunk  BLOCK (1 BLK)", "MISS Dunk BLOCK"),
            (" S.FOUL (P1.PN)", "FOUL"),
            ("Jump Ball  vs. : Tip to ", "Jump Ball Tip to")]
    df = spark.createDataFrame(rows, "t string, want string")
    out = df.select("want", C.final_tidy(C.drop_words(C.drop_words(C.tidy(F.col("t")), C.ALIAS_WORDS),
                                                      C.STYLE_WORDS)).alias("got")).collect()
    for r in out:
        assert r["got"] == r["want"].replace("Tip to", "to").strip(), r


def test_large_dictionary_splits_hot_grams(spark):
    """One token in every text, a dictionary beyond the bound: same result, and no key of the shuffle is hot."""
    rows = [(f"MISS Name{i % 37} hits Rim {i}",) for i in range(4000)]
    texts = spark.createDataFrame(rows, "d string")
    words = spark.createDataFrame([("Rim",), ("absent",), *[(f"Name{i}",) for i in range(30)], *[(str(i),) for i in range(0, 4000, 3)]], "entry string")
    want = sorted(map(tuple, C.remove_entries(texts, "d", words, "o").collect()))
    assert dict(want)["MISS Name1 hits Rim 1"] == "MISS  hits  1" and dict(want)["MISS Name36 hits Rim 36"] == "MISS Name36 hits  "
    spark.conf.set("courtside.broadcast.maxRows", "60")
    try:
        assert sorted(map(tuple, C.remove_entries(texts, "d", words, "o", hot_rows=200).collect())) == want
        grams = texts.select("d", F.explode(F.split("d", " ")).alias("g")).select("d", F.struct("g").alias("_g"))
        cold, hot, few = C.split_hot_grams(grams, words.select(F.col("entry").alias("_e")), 200)
        assert {r["_e"] for r in few.collect()} == {"Rim"} and {r.g for r in hot.select("_g.g").distinct().collect()} == {"MISS", "hits", "Rim"}
        tasks = sorted(r["count"] for r in cold.repartition(8, "_g.g").groupBy(F.spark_partition_id()).count().collect())
        assert sum(tasks) == 8000 and tasks[-1] <= 3 * tasks[len(tasks) // 2]
    finally:
        spark.conf.unset("courtside.broadcast.maxRows")
