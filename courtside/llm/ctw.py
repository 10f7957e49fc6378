"""Language-model scores by context-tree weighting over bytes.

Each byte is eight binary decisions; every decision (prefix of the byte) has
its own context tree over the previous bytes.  At a node s of depth d, with
counts (n0, n1) from the training documents, the Krichevsky-Trofimov block
probability is KT(s); the weighted one is Pw(s) = KT(s) at the full depth and
(KT(s) + product of Pw over the children) / 2 above.  A text is scored with
the trained tree: a decision's probability is w KT-estimate + (1 - w) (that
of the next depth), w = KT(s) / (2 Pw(s)), mixed over all depths from 0 to
``DEPTH`` along the context; an unseen node says 1/2.  A text's symbols are
its bytes (A-Z lower-cased) and an end mark (0xFF, which UTF-8 never has);
0xFF also fills the context before the start.

Counting, on all documents: a chunk (documents of one scan partition in
their order, ``chunk_bytes`` together) finds its distinct (context, byte)
grams with their training counts, and its distinct tokens.  They go, packed,
to slots: grams by a hash of the two latest context bytes, so that a slot
has whole subtrees, tokens by their hash.  A slot adds up all chunks, works
out its subtrees bottom-up and tells every chunk its answers in the chunk's
own order; only the two topmost depths (at most 256 contexts of 255
decisions) are summed up through the driver.  The model grows with the
corpus and is nowhere held whole.  Texts then meet their chunk's answers in
a cogroup; each is scored whole.

Chunks are found again from the scan (same partition, same row order), so
``docs`` must be a stored table; a difference raises an error.

Defined results: a null or empty text has only its end.  A null id counts as
training.  Every row is counted and scored (repeated rows repeat).  Without
training documents every decision is 1/2 and every count 0; an empty table
gives an empty result; other columns are ignored.  A chunk is at least one
text, so memory grows with the longest text (about 25 times its bytes).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import batches_of, id_and_bytes, ship_package
from courtside.operators.materialize import materialize

DEPTH = 5
END = 255
END_TOKEN = b"\n"  # no word holds white space
_TABLE = 1 << 25
_STEP = 4096

_I = np.arange(1, _STEP)
_LOG_FACT = np.concatenate([[0.0], np.cumsum(np.log(_I))])
_LOG_HALF = np.concatenate([[0.0], np.cumsum(np.log(_I - 0.5))])


def _stirling(x):
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    def half(n):  # ln of (1/2)(3/2)...(n - 1/2)
        return np.where(n < _STEP, _LOG_HALF[np.minimum(n, _STEP - 1)], _stirling(np.maximum(n, 1) + 0.5) - 0.5 * np.log(np.pi))

    n = n0 + n1
    fact = np.where(n < _STEP, _LOG_FACT[np.minimum(n, _STEP - 1)], _stirling(np.maximum(n, 1) + 1.0))
    return half(n0) + half(n1) - fact


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct gram codes, per symbol the index of its gram, first symbol of each text).

    A code holds, from the top, the latest context byte, the one before, ..., and the symbol in its low byte.
    """
    pad = bytes([END]) * DEPTH
    data = np.frombuffer(pad + (bytes([END]) + pad).join(texts) + bytes([END]), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts])
    first = np.cumsum(lengths) - lengths
    symbol = np.ones(len(data), bool)
    for i in range(DEPTH):
        symbol[first + DEPTH * np.arange(len(texts)) + i] = False
    present = np.bincount(data, minlength=256) > 0
    values, base = np.nonzero(present)[0], int(present.sum())
    small = (np.cumsum(present) - 1).astype(np.uint8)[data]

    def earlier(back):
        return small[DEPTH - back:len(small) - back][symbol[DEPTH:]]

    # Grow the gram byte by byte, the latest context byte first; ranks keep the order of the codes.
    ranks, codes = earlier(1).astype(np.int32), values.astype(np.uint64)
    for back in [*range(2, DEPTH + 1), 0]:
        size = len(codes) * base
        x = ranks.astype(np.int32 if size < 2**31 else np.int64) * base + earlier(back)
        kept, ranks = _rank(x, size)
        codes = codes[kept // base] << np.uint64(8) | values[kept % base].astype(np.uint64)
    return codes, ranks, first


def _rank(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of ``x`` (all below ``size``), and the place of each element among them."""
    if size > _TABLE:  # the same by sorting, where a bitmap would be too large
        kept, ranks = np.unique(x, return_inverse=True)
        return kept, ranks.astype(np.int32)
    seen = np.zeros(-(-size // 64) * 64, bool)
    seen[x] = True
    words = np.packbits(seen, bitorder="little").view("<u8")
    before = np.cumsum(np.bitwise_count(words), dtype=np.int32) - np.bitwise_count(words)
    ranks = np.empty(len(x), np.int32)
    for lo in range(0, len(x), 1 << 18):
        part = x[lo:lo + (1 << 18)]
        word = part >> 6
        below = words[word] & ((np.uint64(1) << (part & 63).astype(np.uint64)) - np.uint64(1))
        ranks[lo:lo + (1 << 18)] = before[word] + np.bitwise_count(below)
    return np.nonzero(seen)[0], ranks


def _slot_of(codes: np.ndarray, slots: int) -> np.ndarray:
    two = codes >> np.uint64(8 * (DEPTH - 1))
    return ((two * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(slots)).astype(np.int64)


def is_training(key: int | None) -> bool:
    return zlib.crc32(b"" if key is None else str(key).encode()) % 7 != 2


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of equal keys, and the run of each element."""
    new = np.append(True, keys[1:] != keys[:-1])
    return np.nonzero(new)[0], np.cumsum(new) - 1


def subtree(codes: np.ndarray, counts: np.ndarray, low: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The trees below depth ``low`` for sorted grams with training counts.

    Gives the mixed probability of each gram's eight decisions from depth ``low`` on, and per gram of depth ``low``
    its code, count, and the eight ln Pw of its nodes (each node at its first gram only, else 0).
    """
    levels = [(codes, counts, None)]
    for d in range(DEPTH - 1, low - 1, -1):
        above = levels[-1][0]
        short = above >> np.uint64(16) << np.uint64(8) | above & np.uint64(255)
        code, up = np.unique(short, return_inverse=True)
        levels.append((code, np.bincount(up, levels[-1][1], len(code)).astype(np.int64), up))
    p, top = np.full((len(codes), 8), 0.5), np.zeros((len(levels[-1][0]), 8))
    for bit in range(8):
        below, chain = None, []
        for level, (code, n, up) in enumerate(levels):
            starts, run = _groups(code >> np.uint64(8 - bit))
            one = (code >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
            n1 = np.add.reduceat(np.where(one, n, 0), starts)
            n0 = np.add.reduceat(n, starts) - n1
            kt = log_kt(n0, n1)
            estimate = (np.where(one, n1[run], n0[run]) + 0.5) / (n0 + n1 + 1.0)[run]
            if below is None:
                pw, w = kt, np.ones(len(kt))
            else:
                child_starts, child_pw = below
                inner = np.bincount(run[up[child_starts]], child_pw, len(kt))
                pw = np.logaddexp(kt, inner) + np.log(0.5)
                w = np.exp(kt + np.log(0.5) - pw)
            chain.append((estimate, w[run], up))
            below = starts, pw
        top[below[0], bit] = below[1]
        where, ats = np.arange(len(codes)), []
        for _, _, up in chain:
            where = where if up is None else up[where]
            ats.append(where)
        got = chain[0][0]
        for (estimate, w, _), at in list(zip(chain, ats))[1:]:
            got = w[at] * estimate[at] + (1 - w[at]) * got
        p[:, bit] = got
    return p, levels[-1][0], levels[-1][1], top


def top_tables(by_one: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """From (latest byte, counts[256], sums of the children's ln Pw [256 nodes]): weights and estimates of a 1 at depths 1 and 0."""
    counts, inner = np.zeros((256, 256), np.int64), np.zeros((256, 256))
    for c, n, s in by_one:
        counts[c], inner[c] = n, s

    def nodes(n):  # (…, 256 bytes) -> n0, n1 per decision node 1..255
        tree = np.zeros((*n.shape[:-1], 512), np.int64)
        tree[..., 256:] = n
        for k in range(255, 0, -1):
            tree[..., k] = tree[..., 2 * k] + tree[..., 2 * k + 1]
        k = np.arange(256)
        return tree[..., 2 * k], tree[..., 2 * k + 1]

    n0, n1 = nodes(counts)
    kt = log_kt(n0, n1)
    pw1 = np.logaddexp(kt, inner) + np.log(0.5)
    w1, e1 = np.exp(kt + np.log(0.5) - pw1), (n1 + 0.5) / (n0 + n1 + 1)
    m0, m1 = nodes(counts.sum(0))
    kt0 = log_kt(m0, m1)
    seen = counts.sum(1) > 0
    pw0 = np.logaddexp(kt0, pw1[seen].sum(0)) + np.log(0.5)
    return w1, e1, np.exp(kt0 + np.log(0.5) - pw0), (m1 + 0.5) / (m0 + m1 + 1)


def finish(codes: np.ndarray, p2: np.ndarray, tables: tuple) -> np.ndarray:
    """log10 of the probability of each gram's symbol: depths 1 and 0 mixed in, eight decisions multiplied."""
    w1, e1, w0, e0 = tables
    byte, one = (codes & np.uint64(255)).astype(np.int64), (codes >> np.uint64(8 * DEPTH)).astype(np.int64)
    out = np.zeros(len(codes))
    for bit in range(8):
        node, b = (256 | byte) >> (8 - bit), byte >> (7 - bit) & 1
        p1 = np.where(b, e1[one, node], 1 - e1[one, node])
        p0 = np.where(b, e0[node], 1 - e0[node])
        w = w1[one, node]
        out += np.log10(w0[node] * p0 + (1 - w0[node]) * (w * p1 + (1 - w) * p2[:, bit]))
    return out


class _Chunks:
    """The chunk number of each row of a partition, by the bytes before it."""

    def __init__(self, chunk_bytes: int):
        self.limit, self.held, self.number = chunk_bytes, 0, TaskContext.get().partitionId() << 24

    def next(self, n_bytes: int) -> tuple[int, bool]:
        """(chunk of this row, whether it ends the chunk)"""
        mine = self.number
        self.held += n_bytes + 64
        if self.held >= self.limit:
            self.held, self.number = 0, self.number + 1
            return mine, True
        return mine, False


def _token_order(texts: list[bytes], slots: int) -> tuple[list[list[bytes]], list[list[bytes]]]:
    """Words of each text, and the distinct tokens (end mark included) by slot in order of appearance."""
    words = [t.split() for t in texts]
    seen = dict.fromkeys([END_TOKEN])
    for w in words:
        seen.update(dict.fromkeys(w))
    by_slot: list[list[bytes]] = [[] for _ in range(slots)]
    for t in seen:
        by_slot[zlib.crc32(t) % slots].append(t)
    return words, by_slot


_ASKED = "kind string, slot int, chunk bigint, names binary, counts binary"


def _ask(rows: DataFrame, slots: int, chunk_bytes: int) -> DataFrame:
    """Per chunk and slot: distinct grams or tokens with their training counts."""
    names = [x.split()[0] for x in _ASKED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _Chunks(chunk_bytes)

        def flush(chunk, held):
            texts, train = [t for _, t in held], np.array([is_training(k) for k, _ in held])
            codes, at, first = grams(texts)
            lengths = np.diff(np.append(first, len(at)))
            n = np.bincount(at[np.repeat(train, lengths)], minlength=len(codes))
            slot = _slot_of(codes, slots)
            order = np.argsort(slot, kind="stable")
            cuts = np.searchsorted(slot[order], np.arange(slots + 1))
            out = []
            for s in range(slots):
                mine = order[cuts[s]:cuts[s + 1]]
                if len(mine):
                    d = np.diff(codes[mine], prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]
                    out.append(("gram", s, chunk, np.ascontiguousarray(d.T).tobytes(), n[mine].astype("<u4").tobytes()))
            words, by_slot = _token_order(texts, slots)
            total = Counter({END_TOKEN: int(train.sum())})
            for w, use in zip(words, train):
                if use:
                    total.update(w)
            for s, tokens in enumerate(by_slot):
                if tokens:
                    out.append(("token", s, chunk, b" ".join(tokens), np.array([total.get(t, 0) for t in tokens], "<u4").tobytes()))
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        held = []
        for key, text in batches_of(batches, "_id", "_text"):
            held.append((key, text.lower()))
            chunk, ends = chunks.next(len(text))
            if ends:
                yield flush(chunk, held)
                held = []
        if held:
            yield flush(chunk, held)

    return rows.mapInArrow(run, _ASKED)


_ANSWERED = ("kind string, slot int, chunk bigint, answer binary, codes binary, p binary, latest int, n array<bigint>, inner array<double>, "
             "n_all bigint, n_distinct bigint")


def _learn(asked: DataFrame) -> DataFrame:
    """Per slot: the answers to each chunk (kinds gram: index into the slot's grams; token: counts), the slot's grams with their
    probabilities from depth 2 on (kind model), its share of the depth-1 sums (kind top) and of the token totals (kind total)."""
    names = [x.split()[0] for x in _ANSWERED.split(", ")]

    def tokens(slot, group):
        total: dict[bytes, int] = {}
        for b, c in zip(group["names"], group["counts"]):
            for t, n in zip(b.split(b" "), np.frombuffer(c, "<u4").tolist()):
                total[t] = total.get(t, 0) + n
        out = [{"kind": "token", "slot": slot, "chunk": chunk, "answer": np.array([total[t] for t in b.split(b" ")], "<i8").astype("<u4").tobytes()}
               for chunk, b in zip(group["chunk"], group["names"])]
        return [*out, {"kind": "total", "slot": slot, "n_all": sum(total.values()), "n_distinct": sum(n > 0 for n in total.values())}]

    def model(slot, group):
        parts = []
        for b in group["names"]:
            planes = np.frombuffer(b, np.uint8).reshape(7, -1).T
            d = np.zeros((len(planes), 8), np.uint8)
            d[:, :7] = planes
            parts.append(np.cumsum(d.view("<u8")[:, 0], dtype=np.uint64))
        codes, at = np.unique(np.concatenate(parts), return_inverse=True)
        n = np.bincount(at, np.concatenate([np.frombuffer(c, "<u4") for c in group["counts"]]), len(codes)).astype(np.int64)
        p, code2, n2, pw2 = subtree(codes, n)
        latest, byte = (code2 >> np.uint64(16)).astype(np.int64), (code2 & np.uint64(255)).astype(np.int64)
        out = [{"kind": "model", "slot": slot, "codes": codes.tobytes(), "p": p.astype("<f4").tobytes()}]
        for c in np.unique(latest):
            mine, inner = latest == c, np.zeros(256)
            for bit in range(8):
                np.add.at(inner, (256 | byte[mine]) >> (8 - bit), pw2[mine, bit])
            out.append({"kind": "top", "slot": slot, "latest": int(c), "n": np.bincount(byte[mine], n2[mine], 256).astype(np.int64).tolist(), "inner": inner.tolist()})
        lo = 0
        for chunk, part in zip(group["chunk"], parts):
            out.append({"kind": "gram", "slot": slot, "chunk": chunk, "answer": at[lo:lo + len(part)].astype("<u4").tobytes()})
            lo += len(part)
        return out

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        rows = (model if key[0] == "gram" else tokens)(int(key[1]), group)
        out = pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype=object) for c in names})
        return out.astype({c: "Int64" for c in ("slot", "chunk", "latest", "n_all", "n_distinct")})

    return asked.groupBy("kind", "slot").applyInPandas(run, _ANSWERED)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 4 << 20, slots: int | None = None) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) and bits_per_byte of the score."""
    ship_package(docs.sparkSession)
    rows = id_and_bytes(docs, id_col, text_col)
    n_slots = slots or max(64, docs.select(F.count(F.lit(1))).first()[0] // 4096)  # a count of Parquet rows reads no column
    known = materialize(_learn(_ask(rows, n_slots, chunk_bytes)), "ctw-model")
    total = known.where("kind = 'total'").agg(F.coalesce(F.sum("n_all"), F.lit(0)), F.coalesce(F.sum("n_distinct"), F.lit(0))).first()
    n_all, n_distinct = int(total[0]), int(total[1])

    def add_up(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"latest": [key[0]], "n": [np.sum(np.stack(g["n"]), 0)], "inner": [np.sum(np.stack(g.sort_values("slot")["inner"]), 0)]})

    # At most 256 rows of 256 numbers, whatever the corpus.
    top = known.where("kind = 'top'").select("latest", "slot", "n", "inner").groupBy("latest").applyInPandas(add_up, "latest int, n array<bigint>, inner array<double>").collect()
    tables = top_tables([(r[0], np.array(r[1]), np.array(r[2])) for r in top])

    def final(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        m = group[group["kind"] == "model"].iloc[0]
        codes = np.frombuffer(m["codes"], np.uint64)
        logs = finish(codes, np.frombuffer(m["p"], "<f4").reshape(-1, 8).astype(float), tables).astype("<f4")
        ask = group[group["kind"] == "gram"]
        return pd.DataFrame({"kind": "gram", "slot": key[0], "chunk": ask["chunk"], "answer": [logs[np.frombuffer(a, "<u4")].tobytes() for a in ask["answer"]]})

    answer = "kind string, slot int, chunk bigint, answer binary"
    logs = known.where("kind IN ('model', 'gram')").select("kind", "slot", "chunk", "answer", "codes", "p").groupBy("slot").applyInPandas(final, answer)
    answers = logs.union(known.where("kind = 'token'").select("kind", "slot", "chunk", "answer"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, seen = _Chunks(chunk_bytes), 0
        for b in batches:
            text = b.column(b.schema.get_field_index("_text"))
            ids = pa.array([chunks.next(n)[0] for n in pc.binary_length(text).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(range(seen, seen + b.num_rows), pa.int64()), b.column(b.schema.get_field_index("_id")), text],
                                             names=["_chunk", "_pos", "_id", "_text"])
            seen += b.num_rows

    # A null id travels as a flag, so that ids stay integers in pandas.
    placed = rows.mapInArrow(number, "_chunk bigint, _pos bigint, _id bigint, _text binary").select(
        F.col("_chunk").alias("_c"), "_pos", F.col("_id").isNull().alias("_no_id"), F.coalesce("_id", F.lit(0)).alias("_key"), "_text")
    floor = np.log10(n_all + n_distinct + 1)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({"_key": [], "_no_id": [], "held_out": [], "n_tokens": [], "n_known": [], "train_tokens": [], "base_score": [], "score": [], "bits_per_byte": []})
        left = left.sort_values("_pos")  # the order of the scan, in which tokens were listed
        texts = [bytes(t).lower() for t in left["_text"]]
        told = {(k, s): a for k, s, a in zip(right["kind"], right["slot"], right["answer"])}
        codes, at, first = grams(texts)
        slot = _slot_of(codes, n_slots)
        order = np.argsort(slot, kind="stable")
        logs = np.concatenate([np.frombuffer(told["gram", s], "<f4") for s in np.unique(slot)])
        words, by_slot = _token_order(texts, n_slots)
        listed, count = [], []
        for s, tokens in enumerate(by_slot):
            if tokens:
                listed += tokens
                count.append(np.frombuffer(told["token", s], "<u4"))
        count = np.concatenate(count)
        if len(count) != len(listed):
            raise ValueError("a chunk's tokens differ from those counted: the table changed between two scans")
        if len(logs) != len(codes):
            raise ValueError("a chunk's grams differ from those counted: the table changed between two scans")
        value = np.empty(len(codes))
        value[order] = logs
        mine = np.add.reduceat(value[at], first)
        n_tokens = np.array([len(w) + 1 for w in words])
        place = dict(zip(listed, range(len(listed))))
        token = np.fromiter(map(place.__getitem__, chain.from_iterable([*w, END_TOKEN] for w in words)), np.int32, int(n_tokens.sum()))
        starts = np.cumsum(n_tokens) - n_tokens
        n_known = np.add.reduceat((count > 0).astype(np.int64)[token], starts)
        base = np.add.reduceat(np.log10(count + 1.0)[token], starts) - floor * n_tokens
        symbols = np.array([len(t) + 1 for t in texts])
        held = [not is_training(None if no else k) for k, no in zip(left["_key"].tolist(), left["_no_id"].tolist())]
        return pd.DataFrame({"_key": left["_key"].to_numpy(), "_no_id": left["_no_id"].to_numpy(), "held_out": held, "n_tokens": n_tokens, "n_known": n_known,
                             "train_tokens": n_all, "base_score": base, "score": mine, "bits_per_byte": -mine / np.log10(2) / symbols})

    scored = placed.groupBy("_c").cogroup(answers.groupBy("chunk")).applyInPandas(
        run, "_key bigint, _no_id boolean, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double")
    return scored.select(F.when(~F.col("_no_id"), F.col("_key")).alias(id_col), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
