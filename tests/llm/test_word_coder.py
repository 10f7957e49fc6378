import random

import pytest

from courtside.llm.common import WordCoder, tokenizer, tokenizer_path

ALPHABET = list("aBsret'İΣéÿß̀́漢 \t\n\x0b\x0c\r\x1c\x1f\x85\xa0    .,;:!?&%$#*|-_<>()1²🎉\x00") + ["'s", "<|endoftext|>", "  ", "word", " Word,", "\n\n", "\nNext", ".", " ", " "]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_same_ids_as_whole_texts(name, spaced, odd_docs):
    r, path = random.Random(1), tokenizer_path(name)
    texts = ["".join(r.choices(ALPHABET, k=r.randrange(30))) for _ in range(30_000)] + [x.text or "" for x in odd_docs.collect()]
    got = WordCoder(path, spaced, limit=500).encode([t.encode() for t in texts])
    whole = tokenizer(path).encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in got] == [e.ids for e in whole]
