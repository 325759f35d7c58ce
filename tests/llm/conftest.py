import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_docs(spark):
    """The smallest documents table, whole."""
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, blank and long texts, repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i % 97} x{i % 89}" for i in range(30_000))
    rows = [
        (1, "alpha beta gamma delta epsilon", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, "a"),
        (4, " \t\n ", "en", None),
        (5, "one", "en", "b"),
        (6, "one", "en", "b"),
        (7, long, "de", "b"),
        (8, long, "de", "b"),
        (9, "Él próximo año " * 40, "es", "c"),
        (10, "Él próximo año " * 41, "es", "c"),
        (10, "Él próximo año " * 41, "es", "c"),
        (None, "a row without an id " * 20, "en", "c"),
    ]
    schema = "doc_id long, text string, lang string, source string"
    return spark.createDataFrame(rows, schema).selectExpr(
        "*", "cast(length(text) as long) n_chars", "'x' m", "'y' start", "'z' c", "'q' spans"
    )


@pytest.fixture(scope="session")
def no_docs(small_docs):
    return small_docs.where("false")
