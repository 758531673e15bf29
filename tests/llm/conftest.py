import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()


DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, leaks int, key int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows, columns with clashing names."""
    rows = [
        (1, "one two three four five six seven eight", "en", "s", 5, 1, 1, 1),
        (1, "one two three four five six seven eight", "en", "s", 5, 1, 1, 1),
        (2, None, None, None, None, None, None, None),
        (3, "", "en", "s", 0, 2, 2, 2),
        (None, "alone here", None, "s", 10, None, None, None),
        (4, "word " * 30_000, "en", "s", 150_000, 3, 3, 3),
        (5, "12 34 !!", "en", "s", 8, 3, 3, 3),
    ]
    return spark.createDataFrame(rows, DOCS)
