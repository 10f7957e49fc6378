import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as CP
from test_jaccard_join import brute as components
from test_quality import brute as counts
from test_secret_scan import BASE, S, secret


def redacted(text):
    spans = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(BASE) for m in p.finditer(text) if ok(m)]
    spans += [(m.start(), 3, m.end()) for m in re.finditer(S.CANDIDATE, text) if secret(m[0]) and not any(s <= m.start() and m.end() <= e for s, _, e in spans)]
    out, at = "", 0
    for s, k, e in sorted(spans):
        if s >= at:
            out += text[at:s] + f"[{S.KINDS[k]}]"
        at = max(at, e)
    return out + text[at:]


def test_stages_one_by_one(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for name, stage in CP.STAGES[:3]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns
        before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}
        if name == "quality_rules":  # too few labels to certify a cutoff: the base rules alone
            assert set(after) == {i for i, r in before.items() if not counts(r.text)[5]}
        elif name == "jaccard_join":
            want = {int(x.split(", ")[2][:-1]) for x in components([(i, r.text) for i, r in before.items()], 5, 80)}
            assert set(after) == want and len(want) < len(before)
        else:
            assert {i: (r.text, r.n_chars) for i, r in after.items()} == {i: (redacted(r.text), len(redacted(r.text))) for i, r in before.items()}
        docs = spark.createDataFrame(out.collect(), out.schema)
    pieces = CP.pack(spark, docs, sf_small).collect()
    per_doc = {}
    for p in pieces:
        per_doc.setdefault(p.doc_id, [0, p.doc_tokens])[0] += p.length
    assert set(per_doc) == {r.doc_id for r in docs.collect()} and all(a == b for a, b in per_doc.values())


def test_run(spark, sf_small):
    got = CP.run(spark, sf_small)
    assert got.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.count() > 50


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, odd_docs, sf_small, empty):
    docs = odd_docs.limit(0) if empty else odd_docs
    for _, stage in CP.STAGES:
        docs = stage(spark, docs, sf_small)
        docs.collect()
    assert docs.columns[0] == "doc_id"


def test_clashing_names_are_kept(spark, odd_docs, sf_small):
    """Columns may have the names that the stages use for themselves."""
    clash = ["_q_", "_q_w", "_q_stratum", "_stratum", "_kept", "_base_failed", "_label_id", "_spans__", "_spans___base", "_redacted__", "_k_id", "_k_h", "_k_n",
             "text_hash", "is_first", "c0", "c1", "quality", "_id", "_text"]
    plain = odd_docs.drop("kept", "spans").withColumn("n_chars", F.lit(7))
    docs = plain.select("*", *[F.concat(F.lit(c), F.coalesce("doc_id", F.lit(0))).alias(c) for c in clash])
    for name, stage in CP.STAGES[:3]:
        want = stage(spark, plain, sf_small)
        got = stage(spark, docs, sf_small)
        assert got.columns == docs.columns
        rows = got.collect()
        assert sorted(map(str, (tuple(r)[:4] for r in rows))) == sorted(map(str, map(tuple, want.select(docs.columns[:4]).collect())))
        assert all(r[c] == f"{c}{r.doc_id or 0}" for r in rows for c in clash)
    assert CP.pack(spark, docs, sf_small).count() >= 9
