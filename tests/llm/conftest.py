import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# Nulls in every column, empty and blank texts, ties and repeated rows, a long text, control and
# other planes' characters.
ODD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \t\n\r ", None, None, None),
    (4, "one", "en", "a", 3),
    (5, "one", "en", "a", 3),
    (5, "one", "en", "a", 3),
    (None, "no id here at all, just a text of some words", "en", None, 44),
    (6, "...!!! 123 ---", "en", "b", 14),
    (7, "\U0001f600 é ß ﬁ á \x00 end", "fr", "b", None),
    (8, "x" * 30_000, "de", "b", 30_000),
    (9, "word " * 6_000, "de", "b", 30_000),
    (9, "the same id, another text", "de", "b", 25),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with further columns whose names the operators might use themselves."""
    rows = [(*row, "x", -1, "y", 0.5, "z") for row in ODD]
    more = ", row string, text_hash bigint, hits string, score double, component string"
    return spark.createDataFrame(rows, DOCUMENTS + more)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
