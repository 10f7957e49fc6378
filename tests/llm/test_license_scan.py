import random
import re

import duckdb
import pandas as pd

from courtside.llm import license_scan as L

MIT, ASIS, _, WARRANTY, GPL = (t for _, t in L.TEMPLATES[:5])


def brute(text, threshold=L.THRESHOLD):
    """Every block against every template, and every place of every phrase."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered) if w]
    places = [(i, label) for p, label in L.PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    labels, best, met = {x for _, x in places}, 0.0, 0
    for lo in range(0, max(len(words) - L.STRIDE, 1), L.STRIDE):
        block = set(words[lo:lo + 2 * L.STRIDE])
        for label, t in L.TEMPLATES:
            own = set(L.template_words(t))
            if block and 100 * len(own & block) >= threshold * len(own):
                labels, best, met = labels | {label}, max(best, len(own & block) / len(own)), met + 1
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})),
            ",".join(sorted(labels)), 1.0 if places else best, met)


def mixed(seed, n):
    """Prose of template words and others, with whole, cut and damaged templates in it."""
    rnd, out = random.Random(seed), []
    pool = sorted({w for _, t in L.TEMPLATES for w in L.template_words(t)})[::7] + ["the", "of", "and", "zebra", "sofa", "lamp"] * 6
    while len(out) < n:
        kind = rnd.random()
        if kind < 0.1:
            t = rnd.choice(L.TEMPLATES)[1].split()
            out += [w for w in t if rnd.random() < rnd.choice((1, 0.9, 0.75))]
        elif kind < 0.2:
            out += rnd.choice(list(L.PHRASES)).upper().split()
        else:
            out += rnd.choices(pool, k=rnd.randrange(1, 90))
    return rnd.choice((" ", "\n", ", ", " -- ")).join(out)


def rows_of(found):
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_scan_matches_brute_force_and_sql(spark):
    texts = [mixed(i, 20 + 40 * i) for i in range(24)] + [ASIS, MIT, WARRANTY.upper(), GPL.replace(" ", "\n"), "mit license MIT-license  mit\nlicense",
             "xmit license", "MİT license cc by", "gnu general public license" * 2, ASIS.split("merch")[0], "", None, " .,!", "ccby cc  by é cc—by"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    got = L.scan(docs)
    want = sorted(((i, *brute(t)) for i, t in enumerate(texts)), key=str)
    assert rows_of(got) == want
    assert any(r[7] not in (0.0, 1.0) for r in want) and any(r[5] != r[6] for r in want)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([(i, t) for i, t in enumerate(texts)], columns=["doc_id", "text"]))
    assert sorted((tuple(r) for r in con.execute(L.oracle()).fetchall()), key=str) == want


def test_lower_threshold_finds_more_and_keeps_every_pair(spark):
    texts = [mixed(100 + i, 300) for i in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows_of(L.scan(docs, threshold=55)) == sorted(((i, *brute(t, 55)) for i, t in enumerate(texts)), key=str)


def test_blocks_name_their_place(spark):
    text = "zebra " * 200 + ASIS + " lamp" * 300
    docs = spark.createDataFrame([(7, text)], "doc_id long, text string")
    found = L.find_blocks(L.digest(docs)).collect()
    assert {(r.id, r.label, r.score) for r in found} == {(7, "mit", 1.0)} and {r["at"] for r in found} <= {128, 192}


def test_odd_rows(spark, odd_docs, no_docs):
    got = rows_of(L.scan(odd_docs))
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in odd_docs.collect()), key=str)
    assert L.scan(no_docs).collect() == []
    clash = odd_docs.selectExpr("doc_id", "text", "1 AS row", "2 AS id", "3 AS blocks", "4 AS label", "5 AS `at`", "6 AS template")
    assert rows_of(L.scan(clash)) == got


def test_one_long_text_is_linear(spark):
    import time

    def seconds(n):
        docs = spark.createDataFrame([(1, (ASIS + " ") * n)], "doc_id long, text string")
        t = time.perf_counter()
        assert L.scan(docs).first().n_blocks > n // 8
        return time.perf_counter() - t

    seconds(200)
    small, large = seconds(2000), seconds(8000)  # 0.4 and 1.5 MB in one text
    assert large < 4 * 2.5 * max(small, 1.0)
