import pytest
from pyspark.sql import types as T

EXTRA = ("block", "rid", "words", "start", "node", "key", "digest", "bin", "weight")
LONG = "One line of many words that goes on. " * 60
TEXTS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, "a"), (4, "word", "en", None),
    (5, "word", "en", "b"), (None, "text without an id " * 20, "en", "a"), (6, LONG, "en", "a"), (6, LONG, "en", "a"),
    (7, LONG + "\n" + "long " * 30_000, "de", "b"), (8, "é😀 ü\n" * 50, "de", "b"),
    (9, "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" jo@mail.example.com", "de", "b"),
]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("text", "lang", "source")]
    + [T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in EXTRA]
)


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty and long texts, null and repeated ids, ties, and columns with clashing names."""
    rows = [(i, t, g, s, len(t or ""), *["x"] * len(EXTRA)) for i, t, g, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 0, 0), (4, 1, 0), (5, 1, 0), (6, 1, 0), (None, 1, 0), (7, None, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality long, toxic long")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
