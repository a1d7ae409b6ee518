import pytest

EDGE = [
    (1, "one two three four five six seven"),
    (1, "one two three four five six seven"),
    (2, "one two three four five six seven"),
    (3, ""),
    (4, None),
    (None, "text without an id, but with enough words to be a text of its own"),
    (None, None),
    (5, " \n\n \t"),
    (6, "word " * 20_000),
    (7, "a"),
    (8, "é ñ 日本語 😀 ﬁ ▁ <s> <|endoftext|>"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with names that operators use."""
    rows = [(i, t, "x", 1, "y", 2) for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, _text int, key string, n_words int")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
