"""Tables stored by key in buckets, so that windows, joins and sums per key need no shuffle.

The number of buckets is part of the folder's name: a reader declares the table as it was written
and cannot assume another placement. Tables are external ones of the session's catalog, declared
again by each job, so no lasting catalog is needed. Take no fewer buckets than
``spark.sql.shuffle.partitions``: where a join's other side must move, Spark prefers the larger number
and would move a table of fewer buckets as well.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.operators.neighbours import with_slots
from airwave.operators.skew import heavy_keys

BUCKETS = 200
STREAM = "uid string, slot int, ts timestamp_ntz, off int, channel_name string, program_name string"


def _place(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def buckets_of(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of the table at ``path``, None where there is none."""
    pattern = _place(spark, f"{path.rstrip('/')}/buckets-*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    names = [status.getPath().getName() for status in found]
    if len(names) > 1:
        raise ValueError(f"{path} holds more than one layout: {sorted(names)}")
    return int(names[0].rpartition("-")[2]) if names else None


def _declared(spark: SparkSession, path: str, layout: str, keys: tuple[str, ...], buckets: int) -> str:
    at = f"{path.rstrip('/')}/buckets-{buckets}"
    name = "airwave_" + hashlib.sha256(at.encode()).hexdigest()[:24]
    location = at.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({layout}) USING parquet "
        f"CLUSTERED BY ({', '.join(keys)}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    spark.catalog.refreshTable(name)
    return name


def add(rows: DataFrame, path: str, layout: str, keys: tuple[str, ...], buckets: int = BUCKETS) -> None:
    """Append rows with the columns of ``layout``; one task and one file per bucket.

    ``buckets`` counts for a new table only. No key may hold many rows: see ``add_stream``.
    """
    spark = rows.sparkSession
    stored = buckets_of(spark, path) or buckets
    name = _declared(spark, path, layout, keys, stored)
    columns = spark.table(name).columns
    rows.select(*columns).repartition(stored, *keys).write.insertInto(name)


def read(spark: SparkSession, path: str, layout: str, keys: tuple[str, ...]) -> DataFrame:
    """The table at ``path``; an empty one where nothing is stored yet."""
    stored = buckets_of(spark, path)
    if stored is None:
        return spark.createDataFrame([], layout)
    return spark.table(_declared(spark, path, layout, keys, stored))


def write_stream(
    live: DataFrame, shutdowns: DataFrame, path: str, buckets: int = BUCKETS, heavy: DataFrame | None = None
) -> None:
    """Store the events of a log by user and slot: hours for heavy users, whom no bucket then holds whole.

    The slots rest on all rows of a user, so a log is stored at once and not added to. Rows without
    a user drop out.
    """
    if buckets_of(live.sparkSession, path) is not None:
        raise FileExistsError(f"{path} holds a stream already")
    stream = live.withColumn("off", F.lit(0)).unionByName(shutdowns.withColumn("off", F.lit(1)))
    stream = stream.filter(F.col("uid").isNotNull())
    heavy = heavy_keys(stream) if heavy is None else heavy
    add(with_slots(stream, heavy), path, STREAM, ("uid", "slot"), buckets)


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path, STREAM, ("uid", "slot"))
