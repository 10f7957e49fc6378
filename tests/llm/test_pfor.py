import io
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.llm import pfor as P
from courtside.llm.common import tokenizer, tokenizer_path


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=700))
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint32)
    data, starts = P.encode_blocks(ids)
    assert np.array_equal(P.decode_blocks(np.frombuffer(data, np.uint8), starts), ids)


def test_outliers_go_to_the_exception_list():
    ids = np.full(128, 1000, np.uint32)
    ids[::2] += 3
    ids[5] = 4_000_000_000
    data, _ = P.encode_blocks(ids)
    assert data[4] == 2 and data[5] == 1 and len(data) == 8 + 32 + 5
    assert np.frombuffer(data, "<u4", 1)[0] == 1000


def test_file_gives_documents_back():
    r, sink = np.random.default_rng(0), io.BytesIO()
    sink.close, keep = lambda: None, []
    w = P.FileWriter(sink)
    for i in range(900):
        ids = r.integers(0, 50_000, int(r.integers(1, 1500))).astype(np.uint32)
        keep.append(ids)
        w.add(None if i == 7 else i, ids)
    assert w.close() == (900, sum(map(len, keep)))
    ids, nulls, first, tokens = P.read_file(sink.getvalue())
    assert np.array_equal(tokens, np.concatenate(keep)) and list(np.nonzero(nulls)[0]) == [7] and list(first[:2]) == [0, len(keep[0])]


def expected(rows):
    model = tokenizer(tokenizer_path("byte_bpe_50k.json"))
    out, at = [], 0
    for key, text in rows:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = P.round_trip(docs, file_tokens=5000).orderBy("doc_id").collect()
    assert [tuple(r)[:4] for r in got] == expected(sorted((r.doc_id, r.text) for r in docs.collect()))
    assert len({r.file for r in got}) > 4


def test_odd_rows(odd_docs, no_docs):
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in P.round_trip(odd_docs).collect())
    rows = sorted(((r.doc_id, r.text) for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == [(s, k, n) for k, s, n, _ in expected(rows)]
    assert P.round_trip(no_docs).count() == 0
