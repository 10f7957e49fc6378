import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.llm import packing as P
from courtside.llm.common import tokenizer, tokenizer_path


def check(rows, docs, size):
    model = tokenizer(tokenizer_path("word_bpe_49k.json"))
    want = sorted((k is None, k or 0, [*model.encode(t or "", add_special_tokens=False).ids, 1]) for k, t in docs)
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault((r.doc_id is None, r.doc_id or 0), []).append(r)
    for seq in by_seq.values():
        seq.sort(key=lambda r: r.offset)
        assert [r.offset for r in seq] == list(np.cumsum([0] + [r.length for r in seq[:-1]]))
        n = sum(r.length for r in seq)
    short = [seq[0].sequence_id >> 32 for seq in by_seq.values() if sum(r.length for r in seq) < size]
    assert len(short) == len(set(short))  # one a group
    for flag, key, ids in want:
        mine = [r for r in by_doc[flag, key] if r.doc_tokens == len(ids)]
        same = sum((f, k, len(i)) == (flag, key, len(ids)) for f, k, i in want)
        assert sum(r.length for r in mine) == same * len(ids)
        for r in mine:
            part = ids[r.start:r.start + r.length]
            assert len(part) == r.length > 0 and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert sum(r.length for r in rows) == sum(len(i) for *_, i in want)


def test_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    check(P.pack_documents(docs, group_bytes=50_000).collect(), [(r.doc_id, r.text) for r in docs.collect()], 2048)


def test_odd_rows(odd_docs, no_docs):
    check(P.pack_documents(odd_docs).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()], 2048)
    assert P.pack_documents(no_docs).count() == 0


def brute(lengths, size, linear=1.0, quadratic=1 / 2048):
    """The same dealing, token room and cost kept in plain lists."""
    total = sum(lengths)
    room = [size] * (total // size) + [total % size] * (total % size > 0)
    cost, used, out, rests, full = [0.0] * len(room), [0] * len(room), [], [], 0

    def put(doc, start, n, s):
        out.append((doc, start, n, s, used[s]))
        used[s], room[s], cost[s] = used[s] + n, room[s] - n, cost[s] + linear * n + quadratic * n * n

    for doc, n in enumerate(lengths):
        for j in range(n // size):
            put(doc, j * size, size, full)
            full += 1
        if n % size:
            rests.append((doc, n - n % size, n % size))
    late = []
    for doc, start, n in sorted(rests, key=lambda x: -x[2]):
        fit = [s for s in range(len(room)) if room[s] >= n]
        if fit:
            put(doc, start, n, min(fit, key=lambda s: cost[s]))
        else:
            late.append((doc, start, n))
    order = sorted((s for s in range(len(room)) if room[s]), key=lambda s: cost[s])
    for doc, start, n in late:
        while n:
            take = min(n, room[order[0]])
            put(doc, start, take, order[0])
            start, n = start + take, n - take
            if not room[order[0]]:
                order.pop(0)
    return out


def test_pack_matches_brute_force():
    r = np.random.default_rng(3)
    for k in range(40):
        lengths = [int(x) for x in np.minimum(9000, r.lognormal(4 + k % 3, 1.3, int(r.integers(0, 120)))).astype(int) + 1]
        assert P.pack(lengths, 512, 1.0, 1 / 2048)[0] == brute(lengths, 512)


def test_sequences_do_not_depend_on_partitions(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")

    def packed(n):
        rows = P.pack_documents(docs.repartition(n), group_bytes=200_000).collect()
        length = {}
        for r in rows:
            length[r.sequence_id] = length.get(r.sequence_id, 0) + r.length
        cut = {r.doc_id for r in rows if r.length < r.doc_tokens <= 2048}
        return len(length), sum(x < 2048 for x in length.values()), len({s >> 32 for s in length}), len(cut)

    one, many = packed(1), packed(60)
    assert one[0] * 0.98 <= many[0] <= one[0] * 1.02
    assert one[1] <= one[2] and many[1] <= many[2] and max(one[3], many[3]) < 0.1 * docs.count()


def test_copies_of_one_row_are_spread(spark):
    docs = spark.range(0, 3000, 1, 16).selectExpr("1L AS doc_id", "repeat('one two three ', 40) AS text")
    rows = P.pack_documents(docs, group_bytes=100_000).groupBy(F.shiftright("sequence_id", 32).alias("g")).count().collect()
    assert len(rows) > 8


def test_each_goes_to_the_cheapest_with_room():
    pieces, cost = P.pack([6, 5, 4, 1], 8, 1.0, 1.0)
    assert [p[:4] for p in pieces[:2]] == [(0, 0, 6, 0), (1, 0, 5, 1)] and sorted(P.capacities(16, 8)) == [8, 8]
    assert pieces[2][:4] == (3, 0, 1, 1)  # the 4 finds no room whole; the 1 goes to the cheaper sequence
    assert sum(n for _, _, n, _, _ in pieces) == 16 and cost.sum() == pytest.approx(sum(n + n * n for _, _, n, _, _ in pieces))


def test_costs_are_balanced():
    r = np.random.default_rng(0)
    lengths = [int(x) for x in np.minimum(2048, r.lognormal(5, 1, 4000)).astype(int) + 1]
    pieces, cost = P.pack(lengths, 2048, 1.0, 1 / 2048)
    cut = sum(p[1] > 0 for p in pieces)
    full = cost[: sum(lengths) // 2048]
    assert cut < 0.02 * len(lengths) + 50 and np.median(full) * 1.5 > np.quantile(full, 0.9)
