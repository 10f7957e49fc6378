"""Exact Jaccard self-join of word-shingle sets by T-occurrence search.

Two documents link when |A and B| / |A or B| >= percent / 100.  The result
is exact up to equal 64-bit hashes of different shingles.

1. One pass over the texts makes each document's shingle hashes.  A chunk of
   documents (bounded by tokens) sends them, sorted and packed, to buckets
   of the hash range, with the hash of each owner's whole set; documents of
   one set are one class from here on.
2. A bucket finds which hashes occur in two classes or more, and how many.
   Only those go on, to the class's own bucket.
3. Of two linked sets, the n - ceil(t n) + 1 rarest hashes of each share one
   (prefix filter; the order rarity, then hash, is the same everywhere).  A
   class whose hashes of its own alone fill that prefix links with nothing.
   The others are tied together over shared prefix hashes; the components of
   these ties (blocks) hold every link.
4. In a block, T-occurrence search finds the links: a set asks for the
   earlier sets (by size) that occur in at least T of its inverted lists.
   DivideSkip: the lists are divided into the L longest and the others;
   the short ones are merged (one sort of the concatenated, sorted lists,
   the array form of a heap-merge), sets met T - L times or more stay, and
   are probed in the long lists by binary search, longest list last, until
   they can't reach T any more.  A block of many tokens is cut into parts and
   every pair of parts is searched in a task of its own.
5. Tasks return each set's number of links and a spanning forest of the
   links, never all pairs; their components are the result.

Defined results: a null or empty text, or one of white space, has no
shingles and links with nothing.  Fewer words than a shingle make one
shingle of them all.  Every row gets a result (repeated rows are copies of
each other); a row with a null id links as any other but is never named by
``component_id``; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import batches_of, by_position, id_and_bytes, ship_package
from courtside.llm.components import components
from courtside.operators.materialize import materialize

_NO_ID = np.iinfo(np.int64).max  # stands for a null id, after every other
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MU = 0.0085  # cost of a probe against that of a merge step, as published for DivideSkip


class _Words(dict):
    """Word -> 64-bit hash, remembered."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w, 17)
        return h


def shingle_hashes(text: bytes, k: int, words: _Words) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles (ASCII lower case, ASCII white space)."""
    ws = text.lower().split()
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, ws), np.uint64, len(ws))
    n = min(k, len(h))
    out = np.full(len(h) - n + 1, np.uint64(n))
    for i in range(n):
        out = (out ^ h[i:len(h) - n + 1 + i]) * _ODD
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _pack(x: np.ndarray) -> bytes:
    """Differences of sorted values, byte planes together: the planes of small differences compress to nothing."""
    d = np.diff(x, prepend=np.uint64(0))
    return np.ascontiguousarray(d.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<u8")[:, 0], dtype=np.uint64)


def _slots(values: np.ndarray, n: int) -> np.ndarray:
    """Even ranges of the 64-bit hashes, in order."""
    return ((values >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _index(rows: DataFrame, k: int, buckets: int, chunk_tokens: int) -> DataFrame:
    """Step 1: per chunk and bucket the hashes with their owners, and the documents whose class lies in the bucket."""
    names = ["bucket", "hashes", "owners", "classes", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()

        def flush(held, docs):
            docs = np.array(docs, np.uint64).reshape(-1, 4)  # id, text hash, class, size
            doc_slot = _slots(docs[:, 2], buckets)
            classes = np.array(list(held), np.uint64)
            sizes = np.array([len(x) for x in held.values()], np.int64)
            codes = np.concatenate([*held.values(), np.zeros(0, np.uint64)])
            order = np.argsort(codes)
            codes, owners = codes[order], np.repeat(np.arange(len(sizes)), sizes)[order]
            cuts = np.searchsorted(_slots(codes, buckets), np.arange(buckets + 1))
            out = []
            for b in range(buckets):
                lo, hi = cuts[b], cuts[b + 1]
                mine = docs[doc_slot == b]
                if hi > lo or len(mine):
                    own, at = np.unique(owners[lo:hi], return_inverse=True)
                    out.append((b, _pack(codes[lo:hi]), at.astype("<u4" if len(own) > 65536 else "<u2").tobytes(), classes[own].tobytes(), mine.tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32())] + [pa.array([r[i] for r in out], pa.binary()) for i in range(1, 5)], names=names)

        held, docs, n = {}, [], 0
        for key, text, text_hash in batches_of(batches, "_id", "_text", "_h"):
            x = shingle_hashes(text, k, words)
            name = xxhash.xxh64_intdigest(x.tobytes(), len(x)) if len(x) else text_hash % 2**64
            docs.append(((_NO_ID if key is None else key) % 2**64, text_hash % 2**64, name, len(x)))
            if len(x) and name not in held:
                held[name] = x
                n += len(x)
            if n >= chunk_tokens or len(docs) >= chunk_tokens // 16:
                yield flush(held, docs)
                held, docs, n = {}, [], 0
        if docs:
            yield flush(held, docs)

    return rows.mapInArrow(run, "bucket int, hashes binary, owners binary, classes binary, docs binary")


def _shared(index: DataFrame, buckets: int) -> DataFrame:
    """Step 2: per bucket the hashes of two classes or more, sent to the classes' buckets; documents pass on."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        codes, owners = [], []
        for h, o, c in zip(group["hashes"], group["owners"], group["classes"]):
            c = np.frombuffer(c, np.uint64)
            if len(c):
                codes.append(_unpack(h))
                owners.append(c[np.frombuffer(o, "<u4" if len(c) > 65536 else "<u2")])
        code, owner = (np.concatenate([*x, np.zeros(0, np.uint64)]) for x in (codes, owners))
        codes = owners = None
        order = np.argsort(code)
        code, owner = code[order], owner[order]
        same = code[1:] == code[:-1]
        twice = np.zeros(len(code), bool)
        twice[1:] |= same
        twice[:-1] |= same
        code, owner = code[twice], owner[twice]
        order = np.lexsort((owner, code))
        code, owner = code[order], owner[order]
        first = np.ones(len(code), bool)
        first[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
        code, owner = code[first], owner[first]
        _, at, n = np.unique(code, return_inverse=True, return_counts=True)
        n = n[at] if len(n) else n
        code, owner, n = code[n > 1], owner[n > 1], np.minimum(n[n > 1], 255).astype(np.uint8)
        order = np.argsort(owner, kind="stable")
        code, owner, n = code[order], owner[order], n[order]
        cuts = np.searchsorted(_slots(owner, buckets), np.arange(buckets + 1))
        docs, out = b"".join(group["docs"]), []
        for b in range(buckets):
            lo, hi = cuts[b], cuts[b + 1]
            mine = docs if b == key[0] else b""
            if hi > lo or mine:
                names, runs = np.unique(owner[lo:hi], return_counts=True)
                out.append((b, names.tobytes(), runs.astype("<u4").tobytes(), code[lo:hi].tobytes(), n[lo:hi].tobytes(), mine))
        return pd.DataFrame(out, columns=["slot", "names", "runs", "codes", "counts", "docs"])

    return index.groupBy("bucket").applyInPandas(run, "slot int, names binary, runs binary, codes binary, counts binary, docs binary")


_CLASSES = ("doc_id bigint, text_hash bigint, class bigint, n_shingles bigint, rep_id bigint, rep_hash bigint, copies bigint, "
            "codes binary, prefix array<bigint>")


def _classes(shared: DataFrame, percent: int) -> DataFrame:
    """Step 3: a row per document (``codes`` null) and a row per class that may link (``doc_id`` and ``text_hash`` null)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        docs = np.frombuffer(b"".join(group["docs"]), np.uint64).reshape(-1, 4)
        docs = docs[np.lexsort((docs[:, 1], docs[:, 0].view(np.int64), docs[:, 2]))]
        name, size = docs[:, 2], docs[:, 3].astype(np.int64)
        ids, text = docs[:, 0].view(np.int64), docs[:, 1].view(np.int64)
        # A document without shingles is alone, whatever others there are.
        head = np.ones(len(docs), bool)
        head[1:] = (name[1:] != name[:-1]) | (size[1:] == 0)
        at = np.cumsum(head) - 1
        starts = np.nonzero(head)[0]
        copies = np.diff(np.append(starts, len(docs)))
        out = [pd.DataFrame({"doc_id": ids, "text_hash": text, "class": name.view(np.int64), "n_shingles": size, "rep_id": ids[starts][at],
                             "rep_hash": text[starts][at], "copies": copies[at], "codes": None, "prefix": None})]
        owner = np.concatenate([np.repeat(np.frombuffer(n, np.uint64), np.frombuffer(r, "<u4")) for n, r in zip(group["names"], group["runs"])])
        code = np.frombuffer(b"".join(group["codes"]), np.uint64)
        count = np.frombuffer(b"".join(group["counts"]), np.uint8)
        order = np.lexsort((code, count, owner))
        owner, code = owner[order], code[order]
        cuts = np.nonzero(np.append(True, owner[1:] != owner[:-1]))[0] if len(owner) else np.zeros(0, np.int64)
        rows, has = [], {int(n): i for i, n in zip(starts[size[starts] > 0], name[starts][size[starts] > 0])}
        for lo, hi in zip(cuts, np.append(cuts[1:], len(owner))):
            i = has[int(owner[lo])]
            n = int(size[i])
            take = n + (-n * percent // 100) + 1 - (n - (hi - lo))  # rarest first; those of this class alone come before
            if take > 0:
                rows.append((int(name[i].view(np.int64)), n, ids[i], text[i], np.sort(code[lo:hi]).tobytes(), code[lo:lo + take].view(np.int64).tolist()))
        if rows:
            out.append(pd.DataFrame({"doc_id": pd.array([None] * len(rows), "Int64"), "text_hash": pd.array([None] * len(rows), "Int64"), "class": [r[0] for r in rows],
                                     "n_shingles": [r[1] for r in rows], "rep_id": [r[2] for r in rows], "rep_hash": [r[3] for r in rows],
                                     "copies": 0, "codes": [r[4] for r in rows], "prefix": [r[5] for r in rows]}))
        return pd.concat([x.astype({"doc_id": "Int64", "text_hash": "Int64"}) for x in out], ignore_index=True)

    return shared.groupBy("slot").applyInPandas(run, _CLASSES)


def t_occurrence_links(sizes: np.ndarray, sets: list[np.ndarray], percent: int, part: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """For each set (ascending sizes) the earlier sets linked with it; with ``part``, only sets of another part.

    ``sets`` hold the hashes that occur elsewhere; ``sizes`` count all hashes.
    """
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.lexsort((owner, token))
    postings = owner[order]
    begin = np.searchsorted(token[order], np.arange(token.max() + 1))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    at = 0
    for x, s in enumerate(sets):
        mine, where = token[at:at + len(s)], place[at:at + len(s)]
        at += len(s)
        low = int(np.searchsorted(sizes[:x], -(-int(sizes[x]) * percent // 100)))
        least = -(-int(sizes[x]) * percent // 100)  # T for the smallest partner
        starts = begin[mine]
        lengths = where - starts  # entries before x
        keep = lengths > 0
        if low == x or keep.sum() < least:
            continue
        starts, lengths = starts[keep], lengths[keep]
        by = np.argsort(lengths, kind="stable")
        starts, lengths = starts[by], lengths[by]
        n_long = min(least - 1, int(least / (_MU * np.log2(max(2, int(lengths[-1]))) + 1)))
        cut = len(starts) - n_long
        met = np.sort(np.concatenate([postings[a:a + n] for a, n in zip(starts[:cut], lengths[:cut])]))
        met = met[np.searchsorted(met, low):]
        if not len(met):
            continue
        head = np.nonzero(np.append(True, met[1:] != met[:-1]))[0]
        cand, n = met[head], np.diff(np.append(head, len(met)))
        if part is not None:
            other = part[cand] != part[x]
            cand, n = cand[other], n[other]
        # inter / union >= p is inter * (100 + p) >= p * (size + size)
        need = -(-percent * (int(sizes[x]) + sizes[cand]) // (100 + percent))
        for i in range(cut, len(starts)):
            fit = n + (len(starts) - i) >= need
            if not fit.all():
                cand, n, need = cand[fit], n[fit], need[fit]
            if not len(cand):
                break
            lst = postings[starts[i]:starts[i] + lengths[i]]
            n = n + (lst[np.minimum(np.searchsorted(lst, cand), len(lst) - 1)] == cand)
        yield x, cand[n >= need]


def _block_links(parts: DataFrame, percent: int) -> DataFrame:
    """Step 4: (a, b, n): n 0 for a tree edge from a to b; else b is a, and n its number of links found."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), block in group.groupby(["block", "i", "j"], sort=True):
            block = block.sort_values(["n_shingles", "class"], kind="stable")
            names, sizes = block["class"].to_numpy(np.int64), block["n_shingles"].to_numpy(np.int64)
            part = None if i == j else block["part"].to_numpy(np.int64)
            links, root = np.zeros(len(names), np.int64), list(range(len(names)))

            def find(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for x, ys in t_occurrence_links(sizes, [np.frombuffer(c, np.uint64) for c in block["codes"]], percent, part):
                links[x] += len(ys)
                links[ys] += 1
                for y in ys.tolist():
                    a, b = find(x), find(y)
                    if a != b:
                        root[a] = b
                        out.append((int(names[x]), int(names[y]), 0))
            out += [(int(names[x]), int(names[x]), int(links[x])) for x in np.nonzero(links)[0]]
        return pd.DataFrame(out, columns=["a", "b", "n"], dtype="int64")

    return parts.groupBy("task").applyInPandas(run, "a bigint, b bigint, n bigint")


def link_documents(docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text", chunk_tokens: int = 1 << 20,
                   part_tokens: int = 1 << 21) -> DataFrame:
    """Per row: doc_id, text_hash (xxhash64 of the text), n_shingles, component_id, n_links (other sets linked with
    this one), n_copies (rows of the same set), and is_first: the row with the component's smallest id, then text hash."""
    ship_package(docs.sparkSession)
    rows = id_and_bytes(docs, id_col, text_col, F.xxhash64(text_col).alias("_h"))
    buckets = max(32, docs.select(F.count(F.lit(1))).first()[0] // 2048)  # a count of Parquet rows reads no column
    found = materialize(_classes(_shared(_index(rows, k, buckets, chunk_tokens), buckets), percent), "jaccard-classes")
    sets = found.where("codes IS NOT NULL").select("class", "n_shingles", "codes", "prefix")
    ties = sets.select("class", F.explode("prefix").alias("code"))
    hubs = ties.groupBy("code").agg(F.min("class").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select("code", "hub")
    blocks = materialize(components(ties.join(hubs, "code").select(F.col("class").alias("a"), F.col("hub").alias("b"))), "jaccard-blocks")
    placed = materialize(sets.drop("prefix").join(blocks.select(F.col("node").alias("class"), F.col("label").alias("block")), "class")
                         .withColumn("tokens", F.octet_length("codes") / 8), "jaccard-sets")
    cuts = placed.groupBy("block").agg(F.ceil(F.sum("tokens") / part_tokens).cast("int").alias("parts"), F.sum("tokens").alias("all"))
    total = cuts.agg(F.sum(F.col("all") * F.col("parts"))).first()[0] or 0
    tasks = max(32, int(total // part_tokens) * 2)
    parted = placed.join(cuts.select("block", "parts"), "block").withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    spread = parted.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "block", "class", "n_shingles", "codes", "part", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"))
    spread = spread.withColumn("task", F.pmod(F.xxhash64("block", "i", "j"), F.lit(tasks)))
    links = materialize(_block_links(spread, percent), "jaccard-links")
    labels = components(links.where("n = 0").select("a", "b"))
    # Only linked classes are joined here; every other class is its own component.
    reps = found.where("codes IS NOT NULL").select("class", F.struct("rep_id", "rep_hash").alias("rep"))
    member = labels.select(F.col("node").alias("class"), "label").join(reps, "class")
    first = member.groupBy("label").agg(F.min("rep").alias("first"))
    counts = links.where("n > 0").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n_links"))
    linked = materialize(member.join(first, "label").join(counts, "class").select("class", "first", "n_links"), "jaccard-components")
    out = found.where("codes IS NULL").join(linked, "class", "left")
    first_id, first_hash = F.coalesce("first.rep_id", "rep_id"), F.coalesce("first.rep_hash", "rep_hash")

    def null_again(c):
        return F.when(c != F.lit(int(_NO_ID)), c)

    return out.select(null_again(F.col("doc_id")).alias(id_col), "text_hash", "n_shingles", null_again(first_id).alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("copies").alias("n_copies"),
                      ((F.col("doc_id") == first_id) & (F.col("text_hash") == first_hash)).alias("is_first"))


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with its own columns only: the smallest id, then text hash; one of equal rows."""
    linked = link_documents(docs, k, percent, id_col, text_col)
    kept = materialize(linked.where("is_first").groupBy(F.col(id_col).alias("_k_id"), F.col("text_hash").alias("_k_h")).agg(
        F.count(F.lit(1)).alias("_k_n")), "jaccard-kept")
    plain, name = by_position(docs)
    same = F.col(name[id_col]).cast("long").eqNullSafe(F.col("_k_id")) & (F.xxhash64(F.col(name[text_col])) == F.col("_k_h"))
    once = plain.join(kept.where("_k_n = 1"), same, "left_semi")
    # Rows that repeat in id and text (or empty texts with one id): one stays; these are few, so only they are shuffled.
    again = plain.join(kept.where("_k_n > 1"), same, "left_semi")
    return once.unionByName(again.dropDuplicates([name[id_col], name[text_col]])).toDF(*docs.columns)


def oracle(k: int = 4, percent: int = 85) -> str:
    """doc_id, n_shingles and component_id in DuckDB SQL over ``documents``."""
    gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, {gram} AS g FROM w, unnest(range(1, len(w) - {k - 2})) t(i) WHERE len(w) >= {k}
    UNION SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND {k - 1}),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id != b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY 1) m ON m.a = d.doc_id"""
