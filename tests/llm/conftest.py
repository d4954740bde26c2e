import pytest

LONG = "word and others " * 20_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns whose names clash."""
    rows = [
        (1, "A first line of text\nshort\n\nA first line of text", "en", "s", "x", 1),
        (2, "  a FIRST line of text \nanother line of its own here", "en", None, None, 2),
        (2, "  a FIRST line of text \nanother line of its own here", "en", None, None, 2),
        (3, None, None, None, None, None),
        (4, "", "fr", "s", "y", 4),
        (5, LONG, "en", "s", "y", 5),
        (5, "other text under an id that is there twice already, and long enough", "en", "s", "y", 5),
        (None, "a line of text that has no id at all\nA first line of text", "en", "s", "y", 6),
        (None, None, None, None, None, None),
        (7, "  \t\r\n\n éé ÉÉ 42 \x00\x1f ", "fr", "s", "y", 7),
        (8, "A first line of text\nshort\n\nA first line of text", "en", "s", "y", 8),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, DOC_ID string, n_lines long")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
