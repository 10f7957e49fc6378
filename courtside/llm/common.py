"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word pattern of every contract: maximal runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's folder (a no-op where it is installed)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)


def id_and_bytes(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    """Columns ``_id`` (long) and ``_text`` (UTF-8 bytes, null as empty), then ``more``; nothing else travels to Python."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("_id"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("_text"), *more)


def by_position(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns named ``c0``, ``c1``, ... and those names by the old ones: no other name can clash with a helper's."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def batches_of(rows: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches, one tuple at a time, converting a small slice at once."""
    for b in rows:
        for lo in range(0, b.num_rows, 512):
            yield from zip(*columns(b.slice(lo, 512), *names))


def runs_of(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Sorted Arrow batches cut where one of the first ``n_keys`` (integer) columns changes, with those keys."""
    for b in batches:
        if not b.num_rows:
            continue
        key = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(n_keys)], 1)
        cuts = [0, *(np.nonzero((key[1:] != key[:-1]).any(1))[0] + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            yield tuple(key[lo].tolist()), b.slice(lo, hi - lo)


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer file of this name lies on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


_TOKENIZERS: dict = {}


def tokenizer(path: str):
    """The tokenizers-library model at ``path``, loaded once per Python worker, on one thread."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True  # special tokens' strings in a text are ordinary text
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTER = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff"
_MARK = ".,;:!?&%$#*|"


def _re2(chars: str) -> str:
    """A character class's inside in the notation of Arrow's regular expressions."""
    return re.sub(r"\\(?:x([0-9a-f]{2})|u([0-9a-f]{4}))", lambda m: "\\x{" + (m[1] or m[2]) + "}", chars)


_CUT = "\x01"  # stands where a text is cut
#: A space between white space, or at the end after white space: there a byte-level token may cross the space.  Or a cut sign.
_CROSSED = f"[{_re2(_WHITE)}] (?:[{_re2(_WHITE)}]|\\z)|{_CUT}"
#: Between a letter and a mark or line end, and between a single line end and a letter.
_CUTS = [(f"([{_re2(_LETTER)}])([{_MARK}\\n])", f"\\1{_CUT}\\2"), (f"([^{_re2(_WHITE)}])\\n([{_re2(_LETTER)}])", f"\\1\n{_CUT}\\2")]


class WordCoder:
    """Token ids as the tokenizers library gives for whole texts, with the ids of words remembered.

    Both public tokenizers used here never merge across white space, nor between a Latin letter and one of
    ``_MARK``.  Texts are cut before spaces and there (by Arrow, texts with a space inside other white space
    aside), each distinct piece of a slice is looked up once, and its parts are encoded once per worker (in
    bounded number).
    Parts of letters only are encoded many in one call and told apart by their tokens; others one by one.  ``spaced``: white space belongs to the tokens (byte-level BPE); else it is dropped and A-Z count as
    a-z.  The strings of special tokens count as ordinary text (``tokenizer``).
    """

    def __init__(self, path: str, spaced: bool, limit: int = 1_000_000):
        lead = " ?" if spaced else ""
        white = f"|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+" if spaced else ""
        self.cut = re.compile(f"{lead}[{_LETTER}]+(?![^{_MARK}{_WHITE}])|{lead}[{_MARK}]+(?![^{_LETTER}{_WHITE}])|{lead}[^{_WHITE}]+{white}").findall
        self.simple = re.compile(f"{' ' if spaced else ''}[{_LETTER}]+").fullmatch
        self.model, self.spaced, self.limit = tokenizer(path), spaced, limit
        self.known: dict[str, bytes] = {}
        vocabulary = self.model.get_vocab()
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)  # per token its bytes, or whether it ends a word
        for token, i in vocabulary.items():
            self.size[i] = len(token) if spaced else token.endswith("</w>")

    def _learn(self, parts: set[str]) -> None:
        """Encode parts that are not known yet."""
        plain = [x for x in parts if self.simple(x)]
        for lo in range(0, len(plain), 2000):
            some = plain[lo:lo + 2000]
            e, = self.model.encode_batch_fast([("" if self.spaced else " ").join(some)], add_special_tokens=False)
            ids = np.array(e.ids, "<u4")
            # A word's last token: where as many bytes have passed as the words have, or a token that ends words.
            ends = (np.searchsorted(np.cumsum(self.size[ids]), np.cumsum([len(x.encode()) for x in some])) if self.spaced
                    else np.nonzero(self.size[ids])[0])
            ends, raw = [0, *(4 * (ends + 1)).tolist()], ids.tobytes()
            if len(ends) != len(some) + 1 or ends[-1] != len(raw):
                raise ValueError("the tokenizer does not keep words apart")
            self.known.update(zip(some, (raw[a:b] for a, b in zip(ends, ends[1:]))))
        other = list(parts.difference(plain))
        for x, e in zip(other, self.model.encode_batch_fast(other, add_special_tokens=False)):
            self.known[x] = np.array(e.ids, "<u4").tobytes()

    def _raw(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, as bytes."""
        out = list(map(self.known.get, pieces))
        missing = [i for i, x in enumerate(out) if x is None]
        if missing:
            parts = [self.cut(pieces[i]) for i in missing]
            new = {x for p in parts for x in p if x not in self.known}
            if new:
                self._learn(new)
            get = self.known.__getitem__
            for i, p in zip(missing, parts):
                out[i] = self.known[pieces[i]] = b"".join(map(get, p)) if len(p) != 1 else get(p[0])
        return out

    def encode(self, texts: pa.Array | list[bytes]) -> list[np.ndarray]:
        """The ids (uint32) of each UTF-8 text, without special tokens."""
        if len(self.known) > self.limit:
            self.known.clear()
        strings = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())).cast(pa.string())
        if not self.spaced:
            strings = pc.ascii_lower(strings)
        crossed = np.nonzero(pc.match_substring_regex(strings, _CROSSED if self.spaced else _CUT).to_numpy(zero_copy_only=False))[0].tolist()
        whole = dict(zip(crossed, self._raw(strings.take(pa.array(crossed, pa.int64())).to_pylist())))
        strings = pc.replace_substring(strings, " ", _CUT + " " if self.spaced else _CUT)
        for pattern, cut in _CUTS:
            strings = pc.replace_substring_regex(strings, pattern, cut)
        lists = pc.split_pattern(strings, _CUT)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        found = lists.flatten().dictionary_encode()
        codes, first = found.indices.to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
        raw = self._raw(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        length = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        ids = np.frombuffer(b"".join(raw), "<u4")
        each = length[codes]
        ends = np.cumsum(each)
        ids = ids[np.repeat((np.cumsum(length) - length)[codes] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
        ends = np.concatenate([[0], ends])[np.append(first, len(codes))].tolist()
        return [np.frombuffer(whole[i], "<u4") if i in whole else ids[a:b] for i, (a, b) in enumerate(zip(ends, ends[1:]))]


def text_slices(batch: pa.RecordBatch, column: str, size: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of a binary column, or of one row."""
    ends = np.cumsum(pc.binary_length(batch.column(batch.schema.get_field_index(column))).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi
        pa.default_memory_pool().release_unused()  # the worker lives on


_CODERS: dict = {}


def word_coder(path: str, spaced: bool, limit: int = 1_000_000) -> WordCoder:
    """One coder per Python worker: the words of earlier tasks (about ``limit`` of them) are known to later ones."""
    if (path, spaced) not in _CODERS:
        _CODERS[path, spaced] = WordCoder(path, spaced, limit)
    return _CODERS[path, spaced]
