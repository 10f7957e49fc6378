"""Cost-balanced packing of documents into training sequences.

A piece of l tokens costs ``linear * l + quadratic * l * l`` (attention stays
inside a document).  Documents are dealt to groups of about ``group_bytes``
of text by a hash of their id, text and input partition, whatever the
partitions' sizes; the partition salts the hash, so that copies of one row
are spread too.  A group's rows come in a fixed order, are tokenized, and
packed together; a group that grows beyond ``group_tokens`` is packed in
parts, so a task's memory is bounded.

In a group, a document longer than a sequence first yields whole sequences.
The rest is dealt out in descending cost: each goes to the sequence of
lowest cost so far that still has room for all of it.  The sequences of a
group hold exactly the group's tokens: as many full ones as fit and one with
the remainder, the only one to be padded.  What finds no room in one piece
at the end is cut to fill the room that is left, lowest cost first.

The strings of special tokens in a text are ordinary text: the tokenizer is
opened with ``encode_special_tokens``, as its own description asks for.

Defined results: a null or empty text is its end id alone.  Rows are packed
one by one (repeated rows, also with one id, are packed each for itself); a
null id is kept as null; an empty table gives an empty result; other columns
are ignored.  ``sequence_id`` holds the group in its high bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import columns, id_and_bytes, text_slices, tokenizer_path, word_coder

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, cost double")
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def capacities(tokens: int, size: int) -> np.ndarray:
    """Full sequences, then one with the remainder."""
    full, rest = divmod(tokens, size)
    return np.array([size] * full + [rest] * (rest > 0), np.int64)


def pack(lengths: list[int], size: int, linear: float, quadratic: float) -> tuple[list[tuple], np.ndarray]:
    """(document, start, length, sequence, offset) per piece, and the cost of each sequence; every id in one piece."""
    room = capacities(int(sum(lengths)), size)
    cost, used, pieces = np.zeros(len(room)), np.zeros(len(room), np.int64), []

    def put(doc: int, start: int, n: int, seq: int) -> None:
        pieces.append((doc, start, n, seq, int(used[seq])))
        used[seq] += n
        room[seq] -= n
        cost[seq] += linear * n + quadratic * n * n

    rests, full = [], 0
    for doc, n in enumerate(lengths):
        whole = n // size
        for j in range(whole):
            put(doc, j * size, size, full)
            full += 1
        if n % size:
            rests.append((n % size, doc, whole * size))
    rests.sort(key=lambda x: (-x[0], x[1]))
    left = []
    for n, doc, start in rests:
        seq = int(np.argmin(np.where(room >= n, cost, np.inf)))
        if room[seq] >= n:
            put(doc, start, n, seq)
        else:
            left.append((n, doc, start))
    holes = [int(s) for s in np.lexsort((np.arange(len(room)), cost)) if room[s] > 0][::-1]
    for n, doc, start in left:
        while n:
            seq = holes[-1]
            take = min(n, int(room[seq]))
            put(doc, start, take, seq)
            start, n = start + take, n - take
            if not room[seq]:
                holes.pop()
    return pieces, cost


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, end_id: int = 1,
                   path: str | None = None, group_bytes: int = 1 << 22, group_tokens: int = 1 << 22, linear: float = 1.0,
                   quadratic: float = 1 / 2048) -> DataFrame:
    """One row per piece: ``SCHEMA``; ``cost`` is the piece's estimated cost.  Lengths above 0 only."""
    path = path or tokenizer_path("word_bpe_49k.json")
    rows = id_and_bytes(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("_text") + 1)).first()[0] or 0
    groups = max(1, round(total / group_bytes))
    digest = F.xxhash64("_text")
    group = F.pmod(F.xxhash64("_id", digest, F.spark_partition_id()), F.lit(groups)).cast("int").alias("_group")
    dealt = rows.select("_id", "_text", digest.alias("_h"), group).repartition("_group").sortWithinPartitions("_group", "_id", "_h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, held, n_held, now, first = word_coder(path, spaced=False, limit=300_000), [], 0, None, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, n_held, first
            pieces, cost = pack([len(ids) for _, ids in held], size, linear, quadratic)
            out = []
            for doc, start, n, seq, offset in pieces:
                key, ids = held[doc]
                out.append((key, start, n, zlib.crc32(ids[start:start + n]), len(ids), (now << 32) + first + seq, offset,
                            linear * n + quadratic * n * n))
            held, n_held, first = [], 0, first + len(cost)
            kinds = [pa.int64()] * 7 + [pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=_NAMES)

        for b in batches:
            for part in text_slices(b, "_text", 1 << 22):
                keys, places = columns(part, "_id", "_group")
                for key, place, ids in zip(keys, places, model.encode(part.column(1))):
                    if held and (place != now or n_held >= group_tokens):
                        yield flush()
                    if place != now:
                        now, first = place, 0
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4", copy=False)
                    held.append((key, ids))
                    n_held += len(ids)
        if held:
            yield flush()

    return dealt.mapInArrow(run, SCHEMA)
