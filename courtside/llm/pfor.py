"""Token files in patched frame-of-reference (PFOR) blocks.

Ids stand in blocks of ``BLOCK``.  A block stores its minimum, then every
difference to it in a width of bits chosen so that ``PERCENTILE`` of the
block's values fit; the low bits of a value that doesn't fit stay in place
and its position and high bits go to the block's exception list.  The
file's footer has the start of every block and, per document, its id and the
index of its first token, so any document can be read alone.

File (little-endian): ``PFR1`` | blocks | footer | trailer.
  block:   u32 minimum, u8 width, u8 exceptions, u16 values,
           packed low bits (BLOCK * width / 8 bytes),
           u8 positions[exceptions], u32 high bits[exceptions]
  footer:  u64 block starts[blocks], u64 first tokens[documents + 1],
           i64 ids[documents], u8 null ids[documents]
  trailer: u64 tokens, u64 blocks, u64 documents, u64 footer start, ``PFR1``

Documents are range-partitioned by id (nulls first; a hash of the text
splits a repeated id and makes ties definite up to equal texts), sorted and
tokenized in the writing task, which streams blocks to a file in the shared
folder under a temporary name and renames it at the end: a lost or repeated
task leaves no partial file.  File names ascend with the ids.  Reading maps
over the files.  The list of files (name and counts) is a table of its own;
a running sum over it gives every file's first token, joined by the name.

The strings of special tokens in a text are ordinary text: the tokenizer is
opened with ``encode_special_tokens``, as its own description asks for.

Defined results: a null or empty text is its end id alone; every row is
written (repeated rows repeat); an empty table gives no files and an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtside.llm.common import id_and_bytes, ship_package, text_slices, tokenizer_path, word_coder
from courtside.operators.lookup import checked_broadcast
from courtside.operators.materialize import materialize, scratch_path

BLOCK, PERCENTILE, MAGIC = 128, 0.9, b"PFR1"
_HEAD = 8
_SLICE = 2048  # blocks handled at once


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each unsigned value needs (0 for 0)."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def encode_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The blocks of ``ids`` (uint32) and the byte offset of each."""
    n = -(-len(ids) // BLOCK)
    out, sizes = [], []
    for lo in range(0, n, _SLICE):
        part = ids[lo * BLOCK:(lo + _SLICE) * BLOCK]
        rows = -(-len(part) // BLOCK)
        low = np.full((rows, BLOCK), part[-1] if len(part) else 0, np.uint32)
        low.reshape(-1)[:len(part)] = part
        counts = np.full(rows, BLOCK, np.int64)
        counts[-1] = len(part) - (rows - 1) * BLOCK
        least = low.min(1)
        low = low - least[:, None]
        need = _bits(low)
        width = np.sort(need, 1)[:, int(np.ceil(PERCENTILE * BLOCK)) - 1]
        over = need > width[:, None]
        n_exc = over.sum(1)
        size = _HEAD + BLOCK // 8 * width + 5 * n_exc
        start = np.cumsum(size) - size
        buf = np.zeros(int(size.sum()), np.uint8)
        head = np.zeros((rows, _HEAD), np.uint8)
        head[:, :4] = least.astype("<u4").view(np.uint8).reshape(rows, 4)
        head[:, 4], head[:, 5] = width, n_exc
        head[:, 6:] = counts.astype("<u2").view(np.uint8).reshape(rows, 2)
        buf[start[:, None] + np.arange(_HEAD)] = head
        for w in np.unique(width):
            at = np.nonzero(width == w)[0]
            if w:
                kind = "<u2" if w <= 16 else "<u4"  # bits of whole values, the low ones kept
                bits = np.unpackbits(low[at].astype(kind).view(np.uint8).reshape(len(at), BLOCK, -1), axis=2, bitorder="little", count=int(w))
                packed = np.packbits(bits.reshape(len(at), -1), axis=1, bitorder="little")
                buf[(start[at] + _HEAD)[:, None] + np.arange(packed.shape[1])] = packed
        r, pos = np.nonzero(over)
        if len(r):
            rank = np.arange(len(r)) - (np.cumsum(n_exc) - n_exc)[r]
            tail = start[r] + _HEAD + BLOCK // 8 * width[r]
            buf[tail + rank] = pos
            high = (low[r, pos].astype(np.uint64) >> width[r].astype(np.uint64)).astype("<u4")
            buf[(tail + n_exc[r] + 4 * rank)[:, None] + np.arange(4)] = high.view(np.uint8).reshape(-1, 4)
        out.append(buf.tobytes())
        sizes.append(size)
    sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    return b"".join(out), np.cumsum(sizes) - sizes


def decode_blocks(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids (uint32) of the blocks at ``starts`` in ``buf`` (uint8)."""
    out = []
    for lo in range(0, len(starts), _SLICE):
        start = starts[lo:lo + _SLICE].astype(np.int64)
        head = buf[start[:, None] + np.arange(_HEAD)]
        least = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0]
        width, n_exc = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
        counts = np.ascontiguousarray(head[:, 6:]).view("<u2")[:, 0].astype(np.int64)
        low = np.zeros((len(start), BLOCK), np.uint32)
        for w in np.unique(width):
            at = np.nonzero(width == w)[0]
            if w:
                packed = buf[(start[at] + _HEAD)[:, None] + np.arange(BLOCK // 8 * w)]
                bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(at), BLOCK, w)
                kind = np.uint16 if w <= 16 else np.uint32
                value = np.zeros((len(at), BLOCK), kind)
                for k in range(w):
                    value |= bits[:, :, k].astype(kind) << kind(k)
                low[at] = value
        r = np.repeat(np.arange(len(start)), n_exc)
        if len(r):
            rank = np.arange(len(r)) - (np.cumsum(n_exc) - n_exc)[r]
            tail = start[r] + _HEAD + BLOCK // 8 * width[r]
            high = np.ascontiguousarray(buf[(tail + n_exc[r] + 4 * rank)[:, None] + np.arange(4)]).view("<u4")[:, 0]
            low[r, buf[tail + rank]] |= high << width[r].astype(np.uint32)
        low += least[:, None]
        out.append(low[np.arange(BLOCK) < counts[:, None]])
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


class FileWriter:
    """Streams one file: blocks go out as they fill."""

    def __init__(self, sink):
        self.sink, self.held, self.n_held = sink, [], 0
        self.at, self.starts, self.first, self.ids, self.nulls, self.total = len(MAGIC), [], [], [], [], 0
        sink.write(MAGIC)

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.first.append(self.total)
        self.ids.append(key or 0)
        self.nulls.append(key is None)
        self.held.append(ids)
        self.total += len(ids)
        self.n_held += len(ids)
        if self.n_held >= _SLICE * BLOCK:
            self._flush(self.n_held - self.n_held % BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        data, starts = encode_blocks(ids[:n])
        self.starts.append(starts + self.at)
        self.sink.write(data)
        self.at += len(data)
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def close(self) -> tuple[int, int]:
        self._flush(self.n_held)
        starts = np.concatenate(self.starts)
        for a, kind in ((starts, "<u8"), ([*self.first, self.total], "<u8"), (self.ids, "<i8"), (self.nulls, "u1")):
            self.sink.write(np.asarray(a).astype(kind).tobytes())
        self.sink.write(np.array([self.total, len(starts), len(self.ids), self.at], "<u8").tobytes() + MAGIC)
        self.sink.close()
        return len(self.ids), self.total


def read_file(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, null flags, first tokens with the total at the end, token ids) of a file."""
    if content[:4] != MAGIC or content[-4:] != MAGIC:
        raise ValueError("not a PFR1 file")
    total, n_blocks, n_docs, at = (int(x) for x in np.frombuffer(content, "<u8", 4, len(content) - 36))
    starts = np.frombuffer(content, "<u8", n_blocks, at)
    first = np.frombuffer(content, "<u8", n_docs + 1, at + 8 * n_blocks)
    ids = np.frombuffer(content, "<i8", n_docs, at + 8 * (n_blocks + n_docs + 1))
    nulls = np.frombuffer(content, "u1", n_docs, at + 8 * (n_blocks + 2 * n_docs + 1))
    tokens = decode_blocks(np.frombuffer(content, np.uint8), starts)
    if len(tokens) != total:
        raise ValueError("token count differs from the trailer's")
    return ids, nulls, first, tokens


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder Spark names (a missing or short ``file:`` scheme means local)."""
    folder = re.sub(r"^file:/+", "/", folder)
    return (fs.LocalFileSystem(), folder) if folder.startswith("/") else fs.FileSystem.from_uri(folder)


def write_files(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = 2,
                file_tokens: int = 1 << 24) -> DataFrame:
    """Write the files; a stored table of their name, n_docs, n_tokens.  Names ascend with the ids.

    ``file_tokens`` bounds a file (a document is never split).
    """
    path = path or tokenizer_path("byte_bpe_50k.json")
    rows = id_and_bytes(docs, id_col, text_col).withColumn("_h", F.xxhash64("_text"))
    ranged = rows.repartitionByRange(F.col("_id").asc_nulls_first(), "_h").sortWithinPartitions(F.col("_id").asc_nulls_first(), "_h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (store, base), task = word_coder(path, spaced=True), _store(folder), TaskContext.get()
        writer, number, names = None, 0, ["name", "n_docs", "n_tokens"]

        def finish():
            name = f"part-{task.partitionId():06d}-{number:06d}.pfor"
            n_docs, n_tokens = writer.close()
            store.move(temporary, f"{base}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n_docs]), pa.array([n_tokens])], names=names)

        for b in batches:
            for part in text_slices(b, "_text"):
                for key, ids in zip(part.column(0).to_pylist(), model.encode(part.column(1))):
                    if writer is None:
                        store.create_dir(base, recursive=True)
                        temporary = f"{base}/_{task.partitionId()}-{task.taskAttemptId()}-{number}"
                        writer = FileWriter(store.open_output_stream(temporary))
                    writer.add(key, np.append(ids, np.uint32(end_id)))
                    if writer.total >= file_tokens:
                        yield finish()
                        writer, number = None, number + 1
        if writer is not None:
            yield finish()

    return materialize(ranged.mapInArrow(run, "name string, n_docs bigint, n_tokens bigint"), "pfor-files")


def read_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32, file.  ``files``: the table of ``write_files``."""
    ship_package(spark)
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, file string"
    if files.isEmpty():
        return spark.createDataFrame([], schema)
    # One row per file, so this window stays small; names ascend with the ids.
    before = F.sum("n_tokens").over(Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1))
    offsets = files.select(F.col("name").alias("file"), F.coalesce(before, F.lit(0)).alias("_before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                name = b.column(0)[row].as_py().rsplit("/", 1)[-1]
                ids, nulls, first, tokens = read_file(b.column(1)[row].as_buffer().to_pybytes())
                ends = first.astype(np.int64)
                tokens = tokens.astype("<u4", copy=False)
                crc = [zlib.crc32(tokens[s:e]) for s, e in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64(), mask=nulls.astype(bool)), pa.array(ends[:-1]), pa.array(np.diff(ends)),
                     pa.array(crc, pa.int64()), pa.array([name] * len(ids), pa.string())], names=[x.split()[0] for x in schema.split(", ")])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(folder)
    rows = found.select("path", "content").mapInArrow(run, schema)
    return rows.join(checked_broadcast(offsets), "file").select(
        "doc_id", (F.col("start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32", "file")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` under the shared folder and read them back, per document."""
    folder = scratch_path(docs, "tokens-pfor")
    return read_files(docs.sparkSession, folder, write_files(docs, folder, **options))
