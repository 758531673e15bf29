"""Report tables as Parquet, partitioned by (user_type, grain)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = ["user_type", "grain"]


def append_load(parts: list[DataFrame], path: str) -> None:
    """Add the rows of several sources to one table."""
    rows = reduce(DataFrame.unionByName, parts)
    rows.write.mode("append").partitionBy(*PARTITIONS).parquet(path)


@contextmanager
def staged(rows: DataFrame, path: str) -> Iterator[DataFrame]:
    """The rows, computed once and written beside the table at ``path``, for export and load.

    The place is removed at the end, also after an error, which leaves the table as it was.
    """
    spark = rows.sparkSession
    at = f"{path.rstrip('/')}.staging/{uuid.uuid4().hex}"
    try:
        rows.write.parquet(at)
        yield spark.read.schema(rows.schema).parquet(at)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(at)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _slice(like: DataFrame, path: str, user_type: int, grain: str) -> DataFrame | None:
    """The stored rows of a slice with the columns of ``like``, None where there is no table yet."""
    try:
        table = like.sparkSession.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return table.filter((F.col("user_type") == user_type) & (F.col("grain") == grain))


def replace_load(fresh: DataFrame, path: str, user_type: int, grain: str, after) -> None:
    """Delete one user type's rows with a key above ``after``, then load ``fresh``.

    Only the touched partition is rewritten, in one commit: its older rows are read back
    and written together with the new ones. ``fresh`` has the key named like the grain
    (``day`` for hours); it is computed once, before the table is touched.
    """
    with staged(fresh, path) as rows:
        load_staged(rows, path, user_type, grain, after)


def load_staged(fresh: DataFrame, path: str, user_type: int, grain: str, after) -> None:
    """``replace_load`` of rows that lie in files already."""
    key = "day" if grain == "hour" else grain
    rows = fresh.withColumns({"user_type": F.lit(user_type), "grain": F.lit(grain)})
    stored = _slice(rows, path, user_type, grain)
    if stored is not None:
        kept = stored.filter(F.col(key) <= F.lit(after)).select(*rows.columns)
        rows = kept.unionByName(rows)
        if rows.isEmpty():
            # Nothing is left: a dynamic overwrite would not touch the old files.
            leaf = f"{path}/user_type={user_type}/grain={grain}"
            fresh.drop(*PARTITIONS).limit(0).write.mode("overwrite").parquet(leaf)
            return
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def write_summaries(summaries: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Period summaries by grain, so that readers of one grain open only its directory."""
    summaries.write.mode(mode).partitionBy("grain").parquet(path)
