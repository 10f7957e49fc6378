import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from courtside.llm import spm_dropout as S
from courtside.llm.common import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
MODEL = S._model(PATH)
TEXTS = ["", "Hello  world", " leading", "trailing  ", "naïve ñandú ﬁ 🎉\n\ttabs", "▁ literal ▁▁ blocks▁", "a" * 300, "   ", "the quick brown fox " * 50, "\x00\x01", "ab\U0010FFFFc"]


def test_dropout_zero_is_the_model_itself():
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [t for t in TEXTS if "▁" not in t and "\x00" not in t]
    got = S.Encoder(MODEL, 1, 0.0).encode(list(range(len(texts))), texts)
    assert [x.tolist() for x in got] == [sp.encode(t) for t in texts]


def agenda(word, key, dropout):
    """One word, one merge at a time."""
    parts = [(MODEL.char[ord(c)] if MODEL.char[ord(c)] >= 0 else -1 - ord(c), i, 1) for i, c in enumerate(word)]
    while True:
        best = None
        for i, (a, b) in enumerate(zip(parts, parts[1:])):
            made = int(MODEL.merge_of(np.array([a[0]], np.int64), np.array([b[0]], np.int64))[0])
            if made < 0:
                continue
            m = 2**64 - 1
            k1, k2 = int(S._K1), int(S._K2)
            h = key ^ ((a[1] * k1 + a[2] * k2 + b[2] * (k1 ^ k2)) & m)
            h = (h ^ (h >> 31)) * k2 & m
            h = (h ^ (h >> 29)) * k1 & m
            if (h >> 11) < int(dropout * 2**53):
                continue
            if best is None or MODEL.rank[made] < best[0]:
                best = MODEL.rank[made], i, made
        if best is None:
            return [p for p, *_ in parts]
        _, i, made = best
        parts[i:i + 2] = [(made, parts[i][1], parts[i][2] + parts[i + 1][2])]


def test_rounds_equal_the_agenda():
    words = ["▁internationalization", "▁the", "▁▁▁spaces", "banana", "▁aaaaaaaaaa", "▁mississippi", "x"]
    for dropout in (0.0, 0.1, 0.5):
        keys = np.array([12345 + 7 * i for i in range(len(words))], np.uint64)
        got = MODEL.segment(words, keys, dropout)
        assert [np.frombuffer(x, "<i4").tolist() for x in got] == [agenda(w, int(k), dropout) for w, k in zip(words, keys)]


def test_long_words_equal_the_agenda():
    import random

    r = random.Random(4)
    words = ["".join(r.choices(["the", "ing", "a", "tion", "é", "x9", "🎉", "漢", "aaaa"], k=60)) for _ in range(4)] + ["a" * 200, "\n".join(["word"] * 40)]
    for dropout in (0.0, 0.1, 0.6, 1.0):
        keys = np.array([99 + 7 * i for i in range(len(words))], np.uint64)
        got = MODEL.segment(["short", *words], np.append(np.uint64(5), keys), dropout)[1:]
        for x, w, k in zip(got, words, keys):
            want = agenda(w, int(k), dropout)
            assert np.frombuffer(x, "<i4").tolist() == MODEL._spell(np.array(want, np.int64), np.zeros(len(want), np.int64))[0].tolist()


def test_time_is_near_linear_in_the_length_of_a_word():
    import time

    def seconds(n):
        text = ("thequickbrownfoxandtheinternationalorganization\n" * (n // 48))
        t = time.perf_counter()
        assert MODEL.decode(S.Encoder(MODEL, 1, 0.1).encode([1], [text])[0].tolist()) == text
        return time.perf_counter() - t

    seconds(10_000)
    assert seconds(400_000) < 2.5 * seconds(200_000)
    assert seconds(1_000_000) < 20


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5), st.sampled_from([0.0, 0.1, 0.6, 1.0]))
def test_every_text_decodes_to_itself(texts, dropout):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids = S.Encoder(MODEL, 3, dropout).encode(list(range(len(texts))), texts)
    assert [MODEL.decode(x.tolist()) for x in ids] == texts


def test_segmentations_vary_and_repeat():
    text = "the international organization of segmentation " * 40
    one, two = (S.Encoder(MODEL, 1, 0.1).encode([5], [text])[0].tolist() for _ in range(2))
    other = S.Encoder(MODEL, 2, 0.1).encode([5], [text])[0].tolist()
    plain = S.Encoder(MODEL, 1, 0.0).encode([5], [text])[0].tolist()
    assert one == two and one != other and len(one) > len(plain)
    assert S.Encoder(MODEL, 1, 1.0).encode([5], ["word"])[0].tolist() == [int(MODEL.char[ord(c)]) for c in "▁word"]


def test_every_occurrence_is_the_agenda_with_its_own_key():
    text = "the banana  internationalization ▁x mississippi é🎉 " + "counterrevolutionaries-and-more " + "the banana mississippi " * 60
    words = S._WORD.findall(" " + text)
    for dropout in (0.1, 0.25, 0.5):
        coder = S.Encoder(MODEL, 1, dropout)
        for key in (5, None):  # the second text meets known trees
            want = b"".join(np.array(agenda(S._spelled(w), int(k), dropout), np.int64).astype("<i8").tobytes()
                            for w, k in zip(words, coder.keys(key, text, len(words))) if "▁" not in w and w.isascii())
            got = coder.encode([key], [text])[0]
            plain = [coder.model.segment([S._spelled(w)], np.array([k], np.uint64), dropout)[0] for w, k in zip(words, coder.keys(key, text, len(words)))]
            assert got.tobytes() == b"".join(plain)
            assert want == b"".join(np.frombuffer(x, "<i4").astype("<i8").tobytes() for w, x in zip(words, plain) if "▁" not in w and w.isascii())


def test_skip_rate_and_number_of_segmentations():
    n = 20_000  # " a" has one candidate merge
    ids = [len(x) for x in S.Encoder(MODEL, 1, 0.1).encode(list(range(n)), ["a"] * n)]
    assert set(ids) == {1, 2} and abs(ids.count(2) / n - 0.1) < 0.01  # of copies of one text
    one = S.Encoder(MODEL, 1, 0.1).encode([1], [" ".join(["a"] * n)])[0]  # and of occurrences in one text
    assert abs((len(one) - n) / n - 0.1) < 0.01

    def distinct(k):
        return len({x.tobytes() for x in S.Encoder(MODEL, 1, 0.1).encode(list(range(k)), ["internationalization"] * k)})

    assert 4 < distinct(40) < distinct(400) < distinct(4000)
    same = [x.tolist() for x in S.Encoder(MODEL, 1, 0.1).encode([3, 3, None, None], ["mississippi " * 9] * 4)]
    assert same[0] == same[1] != same[2] == same[3]


def test_table_and_odd_rows(spark, sf_small, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = S.round_trips(docs)
    assert got.where("NOT lossless").count() == 0 and got.count() == docs.count()
    for rows in (odd_docs, docs.limit(20)):
        back = S.decode(S.encode(rows))
        want = rows.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        assert sorted(map(str, back.collect())) == sorted(map(str, want.collect()))
    assert S.round_trips(no_docs).count() == 0 and S.encode(no_docs).count() == 0
