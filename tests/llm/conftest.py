import pytest

#: Texts that every operator has to take: null, empty, blank, repeated, one word, a very long one.
LONG = " ".join(f"word{i % 977} of{i}" for i in range(40_000))
DOCS = [
    (1, "the quick brown fox jumps over the lazy dog by the river", "en", "src1"),
    (2, "the quick brown fox jumps over the lazy dog by the river", "en", "src1"),
    (3, None, None, None),
    (4, "", "de", "src12"),
    (5, " \n\t ", "de", "src12"),
    (6, "word", "fr", "src2"),
    (6, "word", "fr", "src2"),
    (None, "a text without an id that still has words", "fr", "src2"),
    (7, LONG, "en", "src1"),
    (8, "bad line " * 30, "en", "src1"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark):
    """Odd documents, with an extra column whose name clashes with those that operators add."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(DOCS, SCHEMA)
    clashing = ["n_chars", "score", "n_words", "epoch", "label", "id", "rep", "region", "bytes", "page", "y"]
    return df.withColumns({c: F.lit(1) for c in clashing})


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
