import pytest

LONG = " ".join(f"w{i % 977} token{i}" for i in range(20_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash with results."""
    rows = [(1, "Hello there, world!", "en", 7, "x"), (2, None, "en", None, None), (3, "", None, 0, "y"),
            (None, "an id is missing here", "de", 1, None), (4, LONG, "en", 2, "z"), (5, "same text twice", "fr", 3, "s"),
            (5, "same text twice", "fr", 3, "s"), (6, " \n\t ", "es", 4, "w"), (7, "héé ▁ ñandú 🎉   end\n\nline", "es", 5, "u")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int, spans string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
