import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SMALL = "/root/testdata/sf0.001"
SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("source", StringType()),
                     StructField("lang", StringType()), StructField("n_chars", LongType()), StructField("Score", StringType()), StructField("size", StringType()), StructField("row_key", StringType())])

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta.", "a"), (2, "ALPHA beta gamma delta epsilon zeta.", "a"), (3, "alpha beta gamma delta epsilon zeta.", None),
    (3, "alpha beta gamma delta epsilon zeta.", None), (4, None, "a"), (5, "", "b"), (6, "  \n\t ", "b"), (7, "one two", "b"), (8, "One two", "b"),
    (9, LONG, "c"), (10, LONG + " tail", "c"), (None, "no id here, none at all, not even one", "c"), (None, "no id here, none at all, not even one", "c"),
    (11, "çà et là, ÉTÉ été 東京都 " * 30, None), (12, "x" * 5000, "a"), (13, "a\x00b c <|endoftext|> d", "a"), (7, "same id, other text", "b"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names clash."""
    return spark.createDataFrame([(i, t, s, None, None, "s", "z", "k") for i, t, s in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
