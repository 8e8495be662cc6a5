import pytest


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text) rows, with further columns whose names the operators use themselves."""

    def make(rows, lang=None):
        extra = (lang, "s", 3, 1, 2, "f", "p", "x", 0)
        schema = "doc_id long,text string,lang string,source string,n_chars long,a long,b int,found string,spans string,x string,fp long"
        return spark.createDataFrame([(*row, *extra) for row in rows], schema)

    return make


@pytest.fixture
def edge_rows():
    """Null and repeated rows, a null id, empty and blank texts, a long one, and private characters."""
    long_text = "word another Third " * 20_000
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, long_text), (5, "same text here"), (5, "same text here"), (6, "same text here"),
        (None, "no id at all"), (None, None), (7, " é 漢字 \U0001f600 password=abcdefghijkl"), (8, "A"), (8, "another text with one id"),
    ]
