import pytest

SF_SMALL = "/root/testdata/sf0.001"

#: Two rows of equal text, near copies, nulls, empties, ties, long and odd texts.
LONG = " ".join(f"w{i % 977} x{i * i % 1009}" for i in range(30_000))
BASE = " ".join(f"Word{i}" for i in range(120))
ROWS = [
    (5, BASE), (1, BASE.lower()), (9, BASE.replace("Word60", "other")), (2, None), (3, ""), (4, " \n\t "),
    (7, LONG), (8, LONG + " end"), (11, "é ß Ünï 漢字 😀 " * 3), (12, "one"), (13, "ONE"), (14, "one two three"),
    (15, "a\x00b ▁ c  d e"), (16, "1 2 3 !!! ..."), (None, "no id here"), (20, BASE), (20, BASE),
]


@pytest.fixture()
def docs(spark):
    """Small documents with every edge case, and extra columns whose names clash with the operators'."""
    rows = [(i, t, "en", "s", len(t or ""), "x", 1.0, 7, "y") for i, t in ROWS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, score double, "
              "n_tokens int, row string")


@pytest.fixture()
def empty(spark, docs):
    return docs.filter("false")


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")
