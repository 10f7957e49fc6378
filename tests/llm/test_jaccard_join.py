import random

import numpy as np
import pytest

from courtside.llm import jaccard_join as J


def sets_of(rows, k):
    out = []
    for key, text in rows:
        w = (text or "").encode().lower().split()
        out.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    return out


def brute(rows, k, percent):
    """(id, set size, component id) of every row."""
    sets, root = sets_of(rows, k), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(str((key, len(s), least.get(find(i)))) for i, ((key, _), s) in enumerate(zip(rows, sets)))


def family(n, size, edits, seed):
    """Near copies of one text, and copies of those, among unrelated texts."""
    r = random.Random(seed)
    base = [f"w{r.randrange(300)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(size)] = f"e{r.randrange(50)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
def test_components_match_brute_force(spark, k, percent):
    texts = family(60, 80, 5, 1) + family(30, 40, 2, 2) + family(20, 9, 1, 3) + ["a b", "A  B", "a", "", None, " \n"] + ["only one of these texts here"]
    r = random.Random(4)
    texts += [" ".join(f"w{r.randrange(300)}" for _ in range(r.randrange(1, 60))) for _ in range(80)] + texts[:15]
    rows = [(i if i % 11 else (None if i % 2 else i), t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, component_id string")
    # Small chunks and parts take every path: many chunks, blocks cut into parts.
    got = J.link_documents(docs, k, percent, chunk_tokens=500, part_tokens=800).collect()
    assert sorted(str((x.doc_id, x.n_shingles, x.component_id)) for x in got) == brute(rows, k, percent)
    whole = J.link_documents(docs, k, percent).collect()
    assert sorted(map(str, whole)) == sorted(map(str, got))


def test_link_counts(spark):
    rows = list(enumerate(family(40, 60, 4, 9)))
    got = {x.doc_id: x for x in J.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85, part_tokens=300).collect()}
    sets = sets_of(rows, 4)
    for i, a in enumerate(sets):
        linked = {b for b in sets if b != a and 100 * len(a & b) >= 85 * len(a | b)}
        assert got[i].n_links == len(linked) and got[i].n_copies == sets.count(a)


def test_search_finds_every_partner():
    r = np.random.default_rng(0)
    base = np.arange(100)
    sets = [np.unique(np.where(r.random(100) < 0.06, r.integers(100, 400, 100), base)).astype(np.uint64) for _ in range(80)]
    sets.sort(key=len)
    sizes = np.array([len(s) for s in sets])
    got = {(x, int(y)) for x, ys in J.t_occurrence_links(sizes, sets, 85) for y in ys}
    want = {(x, y) for x in range(80) for y in range(x) if 100 * len(np.intersect1d(sets[x], sets[y])) >= 85 * len(np.union1d(sets[x], sets[y]))}
    assert got == want and len(want) > 50


def test_table_and_kept_rows(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = J.link_documents(docs, 4, 85).collect()
    assert sorted(str((x.doc_id, x.n_shingles, x.component_id)) for x in got) == brute(rows, 4, 85)
    kept = J.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({int(s.split(", ")[2][:-1]) for s in brute(rows, 5, 80)})


def test_odd_rows(spark, odd_docs, no_docs):
    got = J.link_documents(odd_docs, 4, 85).collect()
    assert sorted(str((x.doc_id, x.n_shingles, x.component_id)) for x in got) == brute([(r.doc_id, r.text) for r in odd_docs.collect()], 4, 85)
    kept = J.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == 8  # of the repeated row one stays
    assert J.link_documents(no_docs, 4, 85).count() == 0 and J.keep_first(no_docs).count() == 0
