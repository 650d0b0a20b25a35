import pytest

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, _rid long, shard int, h1 string, "
        "kept boolean, n long, key string, id string, parts string")
LONG = " ".join(f"word{i % 977} is{i % 13}." for i in range(40_000))


def rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    extra = ("de", "s", 1, 7, 3, "x", True, 5, "k", "i", "p")
    none = (None,) * 11
    return [
        (1, "The same text, twice. It has two sentences.", *extra),
        (2, "The same text, twice. It has two sentences.", *none),
        (2, "The same text, twice. It has two sentences.", *none),
        (2, "Another text under a used id.", *extra),
        (None, None, *none), (None, None, *none), (None, "A text without an id", *extra),
        (5, None, *extra), (6, "", *none), (7, " \n\t ", *extra),
        (8, LONG, *extra), (9, LONG, *none), (10, "été 東京 \U0001F600 ascii", *extra),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(1)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def plain(spark):
    """Maker of small document tables."""
    def make(texts, source="s", lang="en"):
        return spark.createDataFrame([(i, t, lang, source) for i, t in enumerate(texts)],
                                     "doc_id long, text string, lang string, source string")
    return make
