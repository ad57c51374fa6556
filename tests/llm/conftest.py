"""Documents that every operator must cope with."""

import pytest

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, version string, verdict string, score int"


def document(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text or ""), 7, "v", "x", 3)


@pytest.fixture(scope="session")
def odd_rows():
    same = "one two three four five six seven eight nine ten eleven twelve"
    return [
        document(1, same), document(2, same), document(2, same), document(3, None), document(4, ""),
        document(5, " \t\n "), document(6, LONG, None, None), document(7, "word", "fr", "b"), document(None, same),
        document(None, None, None, None), document(8, "4111 é 漢字 \U0001F600 <|x|> \\ \"q\" 12.5", "de", "c"),
    ]


@pytest.fixture
def odd(spark, odd_rows):
    """Nulls, empty and long texts, repeated rows, and extra columns whose names are
    those of results."""
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def docs(spark):
    """A table of (doc_id, text) with the usual other columns."""
    def make(rows):
        return spark.createDataFrame([document(i, t) for i, t in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
