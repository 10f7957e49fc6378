"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

A text becomes pieces by merging neighbours, best-scored pair first, the
leftmost of equal ones (SentencePiece's agenda).  Dropout skips a candidate
merge with probability ``dropout``: whether it is skipped is a keyed hash of
the candidate (seed, document, place of the word in it, first character,
characters left and right), looked at when the candidate comes up, so the
same key always gives the same segmentation, on any machine and retry, and
every occurrence of a word has draws of its own.  Dropout 0 gives exactly
the model's own segmentation.

No piece of the model has a space after another character, so merges never
leave a word (its leading spaces included) and a word's segmentation depends
on the word and its draws alone.  What is remembered, in bounded number, is
a tree per word: its merges in order as long as nothing is skipped, and from
each of these a branch for when it is skipped.  An occurrence walks the tree
by its own draws; branches not seen before are merged at once in numpy, one
merge a word and round, which is the agenda's order in each word.  Long words
and high dropout, where few walks repeat, are merged occurrence by occurrence;
words beyond ``LONG`` characters by a heap of candidates over linked
neighbours, so that a text without spaces takes little more than linear time.

Characters without a piece become byte pieces, and so does U+2581, which
would come back as a space: every text decodes to itself.

Defined results: a null or empty text has no ids and decodes to the empty
string.  Rows are encoded one by one; the document in the key is id and text
(repeated rows, the same in both, repeat, with a null id too); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from courtside.llm.common import batches_of, id_and_bytes, tokenizer_path

SPACE = "▁"
_REAL = "\ud800"
_WORD = re.compile(" *[^ ]+| +")
_NONE = np.iinfo(np.int64).max
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_NEVER = np.int64(1 << 30)  # a rank behind all others
#: Words up to this length have a tree, up to this dropout.
SHORT, HIGH = 24, 0.25
#: Longer words are merged by a heap, shorter ones many at a time.
LONG = 96


def _mark(at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What tells the candidates of a word apart: first character, characters left and right."""
    return at.astype(np.uint64) * _K1 + left.astype(np.uint64) * _K2 + right.astype(np.uint64) * (_K1 ^ _K2)


def _draw(keys: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """53 bits per candidate, which is skipped when they are below ``_bar``."""
    h = keys ^ marks
    h = (h ^ (h >> np.uint64(31))) * _K2
    h = (h ^ (h >> np.uint64(29))) * _K1
    return h >> np.uint64(11)


def _bar(dropout: float) -> np.uint64:
    return np.uint64(min(1.0, max(0.0, dropout)) * (2**53))


_MARKS = _mark(np.arange(1 << 15) >> 10, np.arange(1 << 15) >> 5 & 31, np.arange(1 << 15) & 31)


def _spelled(word: str) -> str:
    """Spaces as U+2581; a surrogate, which no text has, stands for a real U+2581 and is spelled in bytes."""
    return word.replace(SPACE, _REAL).replace(" ", SPACE) if SPACE in word else word.replace(" ", SPACE)


class Model:
    """The pieces of a BPE model as arrays: character pieces, merges sorted by pair, byte pieces."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if proto.trainer_spec.model_type != 2 or proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("a BPE model that keeps its text as it is is needed")
        self.pieces = [p.piece for p in proto.pieces]
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece goes beyond a word")
        self.bytes = np.zeros(256, np.int64)
        for i, p in enumerate(proto.pieces):
            if p.type == 6:
                self.bytes[int(p.piece[1:-1], 16)] = i
        self.spelling = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for b, i in enumerate(self.bytes.tolist()):
            self.spelling[i] = bytes([b])
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        # Every way to make a piece of two pieces; a pair has one result.
        self.n = len(self.pieces)
        pairs = [(normal[p[:k]] * self.n + normal[p[k:]], i) for p, i in normal.items() for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal]
        pairs.sort()
        self.pair, self.made = np.array([a for a, _ in pairs], np.int64), np.array([i for _, i in pairs], np.int64)
        score = np.array([p.score for p in proto.pieces])
        self.rank = np.empty(self.n, np.int64)  # of pieces, best score first
        _, at = np.unique(-score, return_inverse=True)
        self.rank[:] = at
        self.known: dict[int, int] | None = None  # pair to result, for long words
        # A hash table of the pairs without collisions beyond a short probe.
        self.size = 1 << 22
        self.slot = np.full(self.size, -1, np.int32)
        todo = np.arange(len(self.pair))
        self.probes = 0
        while len(todo):
            h = self._hash(self.pair[todo], self.probes)
            free = self.slot[h] < 0
            h, who = h[free], todo[free]
            first = np.unique(h, return_index=True)[1]
            self.slot[h[first]] = who[first]
            todo = np.setdiff1d(todo, who[first])
            self.probes += 1

    def _hash(self, pair: np.ndarray, probe: int) -> np.ndarray:
        x = (pair.astype(np.uint64) + np.uint64(probe * 0x51ED27)) * _K1
        return (x >> np.uint64(42)).astype(np.int64)

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece of each pair, or -1."""
        pair = np.where((left < 0) | (right < 0), -1, left * self.n + right)
        out = np.full(len(pair), -1, np.int64)
        todo = np.nonzero(pair >= 0)[0]
        for probe in range(self.probes):
            at = self.slot[self._hash(pair[todo], probe)]
            hit = (at >= 0) & (self.pair[np.maximum(at, 0)] == pair[todo])
            out[todo[hit]] = self.made[at[hit]]
            todo = todo[(at >= 0) & ~hit]  # a free slot ends the search
        return out

    def segment(self, words: list[str], keys: np.ndarray, dropout: float) -> list[bytes]:
        """The ids (little-endian, 4 bytes each) of each word (spaces as U+2581 already, other U+2581 as byte pieces by the caller)."""
        if not words:
            return []
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words)), lengths)
        start = np.cumsum(lengths) - lengths
        piece = self.char[text].astype(np.int64)
        raw = np.nonzero(piece < 0)[0]
        piece[raw] = -1 - text[raw].astype(np.int64)  # unknown characters, kept as they are until the end
        pos = np.arange(len(text)) - start[word]
        size = np.ones(len(text), np.int64)
        bar = _bar(dropout)
        live = np.arange(len(piece))  # positions in words that may still merge
        done_at, done_piece, done_word = [], [], []
        long = lengths > LONG
        for i in np.nonzero(long)[0].tolist():
            p, at = self._agenda(piece[start[i]:start[i] + lengths[i]], int(keys[i]), dropout)
            done_at.append(at)
            done_piece.append(p)
            done_word.append(np.full(len(p), i))
        if done_at:
            keep = ~long[word]
            piece, word, pos, size = piece[keep], word[keep], pos[keep], size[keep]
            live = piece
        while len(live):
            p, w, at, n = piece, word, pos, size
            same = w[1:] == w[:-1]
            made = np.full(len(p) - 1, -1, np.int64)
            both = np.nonzero(same)[0]
            made[both] = self.merge_of(p[both], p[both + 1])
            cand = np.nonzero(made >= 0)[0]
            if dropout > 0 and len(cand):
                cand = cand[_draw(keys[w[cand]], _mark(at[cand], n[cand], n[cand + 1])) >= bar]
            # The best candidate of each word: by rank, then from the left.
            value = np.full(len(p), _NONE)
            value[cand] = self.rank[made[cand]] << 32 | cand
            heads = np.nonzero(np.append(True, ~same))[0]
            best = np.minimum.reduceat(value, heads)
            best = best[best != _NONE] & 0xFFFFFFFF
            ended = np.ones(len(words), bool)
            ended[w[best]] = False
            out = ended[w]
            done_at.append(at[out])
            done_piece.append(p[out])
            done_word.append(w[out])
            if not len(best):
                break
            p = p.copy()
            n = n.copy()
            p[best] = made[best]
            n[best] += n[best + 1]
            keep = ~out
            keep[best + 1] = False
            piece, word, pos, size = p[keep], w[keep], at[keep], n[keep]
            live = piece
        p, w, at = np.concatenate(done_piece), np.concatenate(done_word), np.concatenate(done_at)
        order = np.lexsort((at, w))
        p, w = p[order], w[order]
        if len(raw):
            p, w = self._spell(p, w)
        cuts = (4 * np.searchsorted(w, np.arange(len(words) + 1))).tolist()
        raw_ids = p.astype("<i4").tobytes()
        return [raw_ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _agenda(self, piece: np.ndarray, key: int, dropout: float) -> tuple[np.ndarray, np.ndarray]:
        """Pieces and first characters of one long word: a heap of candidates over linked neighbours, one merge at a time."""
        n, bar = len(piece), int(_bar(dropout))
        if self.known is None:
            self.known = dict(zip(self.pair.tolist(), self.made.tolist()))
        known, rank, pieces, mask = self.known, self.rank.tolist(), self.n, (1 << 64) - 1
        k1, k2 = int(_K1), int(_K2)
        made = self.merge_of(piece[:-1], piece[1:])
        first = np.nonzero(made >= 0)[0]
        if dropout > 0 and len(first):
            ones = np.ones(len(first), np.int64)
            first = first[_draw(np.full(len(first), key, np.uint64), _mark(first, ones, ones)) >= _bar(dropout)]
        # (rank and place, sizes of both sides, result); an entry whose sides have changed meanwhile is stale.
        heap = [(r << 32 | at, 1, 1, m) for r, at, m in zip(self.rank[made[first]].tolist(), first.tolist(), made[first].tolist())]
        heapq.heapify(heap)
        now, size, left = piece.tolist(), [1] * n, list(range(-1, n - 1))

        def offer(at, to):
            m = known.get(now[at] * pieces + now[to]) if now[at] >= 0 and now[to] >= 0 else None
            if m is None:
                return
            a, b = size[at], size[to]
            if bar:
                h = key ^ ((at * k1 + a * k2 + b * (k1 ^ k2)) & mask)
                h = ((h ^ (h >> 31)) * k2) & mask
                h = ((h ^ (h >> 29)) * k1) & mask
                if h >> 11 < bar:
                    return
            heapq.heappush(heap, (rank[m] << 32 | at, a, b, m))

        while heap:
            value, a, b, m = heapq.heappop(heap)
            at = value & 0xFFFFFFFF
            to = at + a
            if size[at] != a or to >= n or size[to] != b:
                continue
            now[at], size[at], size[to] = m, a + b, 0
            after = at + a + b
            if after < n:
                left[after] = at
                offer(at, after)
            if left[at] >= 0:
                offer(left[at], at)
        at = np.nonzero(np.array(size))[0]
        return np.array(now, np.int64)[at], at

    def trace(self, words: list[str], skip_word: np.ndarray, skip_code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the merges of each word in order, their number, ids, their number; the candidates (word, code) given are skipped.

        Words are as in ``segment``, of ``SHORT`` characters at most; a code has 5 bits each for the first character and the lengths left and right.
        """
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words)), lengths)
        pos = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        piece = self.char[text].astype(np.int64)
        raw = np.nonzero(piece < 0)[0]
        piece[raw] = -1 - text[raw].astype(np.int64)
        size = np.ones(len(text), np.int64)
        skips = np.sort(skip_word << 15 | skip_code)
        made, rank = np.full(len(piece), -1, np.int64), np.full(len(piece), _NEVER)

        def pair_up(at):
            found = self.merge_of(piece[at], piece[at + 1])
            value = np.where(found >= 0, self.rank[found], _NEVER)
            if len(skips):
                code = word[at] << 15 | pos[at] << 10 | size[at] << 5 | size[at + 1]
                value[skips[np.minimum(np.searchsorted(skips, code), len(skips) - 1)] == code] = _NEVER
            made[at], rank[at] = found, value

        pair_up(np.nonzero(word[1:] == word[:-1])[0])
        done, steps = [], []
        while len(piece):
            heads = np.nonzero(np.append(True, word[1:] != word[:-1]))[0]
            best = np.minimum.reduceat(rank << 32 | np.arange(len(piece)), heads)
            goes_on = best < _NEVER << 32
            best = best[goes_on] & 0xFFFFFFFF
            keep = np.ones(len(piece), bool)
            if not goes_on.all():
                keep = np.repeat(goes_on, np.diff(np.append(heads, len(piece))))
                done.append((word[~keep] << 5 | pos[~keep], piece[~keep]))
            steps.append((word[best], pos[best] << 10 | size[best] << 5 | size[best + 1]))
            piece[best] = made[best]
            size[best] += size[best + 1]
            keep[best + 1] = False
            at = np.cumsum(keep)[best] - 1
            piece, word, pos, size, made, rank = (x[keep] for x in (piece, word, pos, size, made, rank))
            made[at], rank[at] = -1, _NEVER
            ends = np.append(word[1:] != word[:-1], True)
            pair_up(np.concatenate([at[~ends[at]], at[pos[at] > 0] - 1]))
        w, p = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(w)
        p, w = p[order], w[order] >> 5
        if len(raw):
            p, w = self._spell(p, w)
        sw, codes = (np.concatenate(x) for x in zip(*steps))
        return codes[np.argsort(sw, kind="stable")], np.bincount(sw, minlength=len(words)), p, np.bincount(w, minlength=len(words))

    def _spell(self, p: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters as byte pieces."""
        at = np.nonzero(p < 0)[0]
        chars, which = np.unique(p[at], return_inverse=True)
        spelled = [self.bytes[list((SPACE if -1 - c == ord(_REAL) else chr(-1 - c)).encode())] for c in chars.tolist()]
        n = np.ones(len(p), np.int64)
        n[at] = np.array([len(x) for x in spelled])[which]
        out, first = np.repeat(p, n), (np.cumsum(n) - n)[at]
        for k in range(4):
            more = np.nonzero(n[at] > k)[0]
            out[first[more] + k] = np.array([x[min(k, len(x) - 1)] for x in spelled])[which[more]]
        return out, np.repeat(w, n)

    def decode(self, ids) -> str:
        text = b"".join(map(self.spelling.__getitem__, ids))
        return (text[1:] if text[:1] == b" " else text).decode()


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers lo, lo + 1, ... of each range, n of them, one range after the other."""
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())


class _Column:
    """An array that grows."""

    def __init__(self, dtype):
        self.data, self.n = np.empty(1024, dtype), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            data = np.empty(max(self.n + len(more), len(self.data) * 3 // 2), self.data.dtype)
            data[:self.n] = self.data[:self.n]
            self.data = data
        self.data[self.n:self.n + len(more)] = more
        self.n += len(more)


class Trees:
    """Per short word a tree of segmentations.

    A node is a set of skipped candidates, with the merges that follow (from the last skipped one's place on) and the
    ids if none of these is skipped; the child of a merge is the node where it is skipped too.
    """

    def __init__(self, model: Model):
        self.model, self.words, self.roots = model, [], {}
        self.code, self.child = _Column(np.int16), _Column(np.int32)  # per merge
        self.ids = _Column(np.int32)
        # Per node: its merges [lo, hi), place of the first, ids [id_lo, id_lo + id_n), word, parent and the merge there that is skipped here.
        self.lo, self.hi, self.place, self.id_lo, self.id_n, self.word, self.parent, self.via = (_Column(np.int32) for _ in range(8))

    def add_words(self, words: list[str]) -> None:
        for lo in range(0, len(words), 50_000):
            part = words[lo:lo + 50_000]
            self.roots.update(zip(part, range(self.lo.n, self.lo.n + len(part))))
            none = np.full(len(part), -1)
            which = np.arange(len(self.words), len(self.words) + len(part))
            self.words += part
            self._add(which, none, none, np.zeros(len(part), np.int64))

    def add_children(self, parent: np.ndarray, via: np.ndarray) -> None:
        for lo in range(0, len(via), 50_000):
            p, v = parent[lo:lo + 50_000], via[lo:lo + 50_000]
            self.child.data[v] = np.arange(self.lo.n, self.lo.n + len(v))
            self._add(self.word.data[p], p, v, self.place.data[p] + v - self.lo.data[p])

    def _add(self, which: np.ndarray, parent: np.ndarray, via: np.ndarray, place: np.ndarray) -> None:
        skip_word, skip_code, who, p, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.arange(len(which)), parent, via
        while (up := p >= 0).any():
            who, p, v = who[up], p[up], v[up]
            skip_word.append(who)
            skip_code.append(self.code.data[v].astype(np.int64))
            p, v = self.parent.data[p], self.via.data[p]
        codes, n, ids, n_ids = self.model.trace([_spelled(self.words[i]) for i in which.tolist()], np.concatenate(skip_word), np.concatenate(skip_code))
        rest = n - place
        codes = codes[_ranges(np.cumsum(n) - rest, rest)]
        lo = self.code.n + np.cumsum(rest) - rest
        for column, more in ((self.lo, lo), (self.hi, lo + rest), (self.place, place), (self.id_lo, self.ids.n + np.cumsum(n_ids) - n_ids), (self.id_n, n_ids),
                             (self.word, which), (self.parent, parent), (self.via, via), (self.code, codes), (self.child, np.full(len(codes), -1)), (self.ids, ids)):
            column.add(more)

    def walk(self, node: np.ndarray, keys: np.ndarray, bar: np.uint64) -> np.ndarray:
        """The node that each occurrence ends at, from its word's root and its key."""
        node, left = node.copy(), np.arange(len(node))
        while len(left):
            lo, n = self.lo.data[node[left]].astype(np.int64), (self.hi.data[node[left]] - self.lo.data[node[left]]).astype(np.int64)
            merge, who = _ranges(lo, n), np.repeat(left, n)
            skipped = np.nonzero(_draw(keys[who], _MARKS[self.code.data[merge]]) < bar)[0]
            merge, who = merge[skipped], who[skipped]
            first = np.append(True, who[1:] != who[:-1])[:len(who)]
            merge, left = merge[first], who[first]
            new, at = np.unique(merge[self.child.data[merge] < 0], return_index=True)
            if len(new):
                self.add_children(node[left[self.child.data[merge] < 0][at]], new)
            node[left] = self.child.data[merge]
        return node


class Encoder:
    """Texts to ids; every occurrence of a word has draws of its own.

    ``limit`` bounds the words remembered,
    four times as many are the nodes of their trees.
    """

    def __init__(self, model: Model, seed: int, dropout: float, limit: int = 600_000):
        self.model, self.seed, self.dropout, self.limit = model, seed & (2**64 - 1), dropout, limit
        self.short = SHORT if dropout <= HIGH else 0
        self.trees = Trees(model)

    def keys(self, key, text: str, n: int) -> np.ndarray:
        """A key per word of a document."""
        own = xxhash.xxh64_intdigest(text.encode(), xxhash.xxh64_intdigest(repr(key).encode(), self.seed))
        x = np.uint64(own) + np.arange(1, n + 1, dtype=np.uint64) * _K1
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def encode(self, keys: list, texts: list[str]) -> list[np.ndarray]:
        t = self.trees
        if len(t.roots) > self.limit or t.lo.n > 4 * self.limit:
            t = self.trees = Trees(self.model)
        lists = [_WORD.findall(" " + text) if text else [] for text in texts]
        words = [w for ws in lists for w in ws]
        draws = np.concatenate([np.zeros(0, np.uint64), *(self.keys(k, x, len(ws)) for k, x, ws in zip(keys, texts, lists) if ws)])
        new = set(words).difference(t.roots)
        t.add_words([w for w in new if len(w) <= self.short])
        node = np.fromiter(map(t.roots.get, words, repeat(-1)), np.int64, len(words))
        n, parts = np.zeros(len(words), np.int64), []
        short, long = np.nonzero(node >= 0)[0], np.nonzero(node < 0)[0]
        for lo in range(0, len(short), 100_000):
            at = short[lo:lo + 100_000]
            end = t.walk(node[at], draws[at], _bar(self.dropout)) if self.dropout > 0 else node[at]
            n[at] = t.id_n.data[end]
            parts.append((at, t.ids.data[_ranges(t.id_lo.data[end].astype(np.int64), n[at])]))
        for lo in range(0, len(long), 50_000):
            at = long[lo:lo + 50_000]
            ids = self.model.segment([_spelled(words[i]) for i in at.tolist()], draws[at], self.dropout)
            n[at] = [len(x) // 4 for x in ids]
            parts.append((at, np.frombuffer(b"".join(ids), "<i4")))
        ends = np.cumsum(n)
        out = np.empty(int(n.sum()), "<i4")
        for at, ids in parts:
            out[_ranges(ends[at] - n[at], n[at])] = ids
        cuts = np.append(0, ends)[np.cumsum([0, *map(len, lists)])].tolist()
        return [out[a:b] for a, b in zip(cuts, cuts[1:])]


_MODELS: dict[str, Model] = {}


def _model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(path: str, seed: int, dropout: float) -> Encoder:
    """One per Python worker: the words of earlier tasks are known to later ones."""
    if (path, seed, dropout) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, seed, dropout] = Encoder(_model(path), seed, dropout)
    return _ENCODERS[path, seed, dropout]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, dropout: float = 0.1, seed: int = 1) -> DataFrame:
    """Per row: doc_id and ids (array of int)."""
    path = path or tokenizer_path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(path, seed, dropout)
        for keys, texts in _held(batches, "_text"):
            ids = coder.encode(keys, [t.decode() for t in texts])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), _lists(ids)], names=["doc_id", "ids"])

    return id_and_bytes(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """Per row: doc_id and text; null or no ids give the empty text."""
    path = path or tokenizer_path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                texts = [model.decode(x or []) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{ids_col}` as ids").mapInArrow(run, "doc_id bigint, text string")


def round_trips(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, dropout: float = 0.1, seed: int = 1) -> DataFrame:
    """Per row, from its ids: doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit), n_chars and n_bytes of the decoded text, lossless."""
    path = path or tokenizer_path("piece_bpe_32k.model")
    names = ["doc_id", "n_ids", "ids_crc32", "n_chars", "n_bytes", "lossless"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        coder = _encoder(path, seed, dropout)
        for keys, texts in _held(batches, "_text"):
            out = []
            for key, text, ids in zip(keys, texts, coder.encode(keys, [t.decode() for t in texts])):
                back = model.decode(ids.tolist())
                raw = back.encode()
                out.append((key, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), len(back), len(raw), raw == text))
            kinds = [pa.int64()] * 5 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return id_and_bytes(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_ids bigint, ids_crc32 bigint, n_chars bigint, n_bytes bigint, lossless boolean")


def _held(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[tuple[list, list]]:
    """Rows in groups of about ``most`` bytes: enough words at once for numpy, bounded memory."""
    keys, texts, size = [], [], 0
    for key, t in batches_of(batches, "_id", text):
        keys.append(key)
        texts.append(t)
        size += len(t)
        if size >= most:
            yield keys, texts
            keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)))
