import pytest

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, sid long, row string, key string, words string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns that clash with names the operators use."""
    long = " ".join(f"w{i * i % 977} x{i}" for i in range(30_000))
    texts = [
        (0, None), (1, ""), (2, " \n\t\r "), (3, "word"), (4, "one two"), (5, long), (5, long), (6, long + " tail"),
        (2**60 + 1, "a key beyond doubles"), (None, "a text without a key that has some words in it"), (None, None), (7, "ÀÉ ß   日本 \x85 é"),
        (8, "same words here " * 30), (9, "same words here " * 30), (8, "same words here " * 30),
    ]
    rows = [(i, t, None if i == 3 else "en", None, len(t or ""), 1, 2, "r", "k", "w") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    """The documents of the smallest input: (doc_id, text) by doc_id."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in sorted(rows, key=lambda r: r.doc_id)}


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
