"""Rows that one job hands to the next: Parquet by day, or gzip text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airwave.functions.text import time_text
from airwave.sinks.text import write_tsv
from airwave.sources import records

PARQUET, TEXT = "parquet", "text"


def _ddl(layout) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in layout)


def write_rows(rows: DataFrame, path: str, layout, *, form: str = PARQUET, files: int = 0) -> None:
    """Columns of ``layout`` in order, and no others.

    Parquet rows that have a day lie in one directory per day, so that readers of a period open its
    days alone. They are rebalanced by day first: a large day takes several files, small days share
    tasks, and tasks don't each write a file into every day. Text rows are as before.
    """
    typed = rows.select(*[rows[name].cast(kind).alias(name) for name, kind in layout])
    if form == TEXT:
        write_tsv(typed, path, files=files, gzip=True)
        return
    if "day" in typed.columns:
        spread = typed.sparkSession.sql("SELECT /*+ REBALANCE(day) */ * FROM {rows}", rows=typed)
        spread.write.partitionBy("day").parquet(path)
        return
    (typed.repartition(files) if files else typed).write.parquet(path)


def read_rows(spark: SparkSession, path: str, layout, form: str = PARQUET) -> DataFrame:
    """What ``write_rows`` wrote. Rows without what ``records.parse_records`` asks for drop out of text."""
    if form == TEXT:
        return records.read_records(spark, path, layout)
    return spark.read.schema(_ddl(layout)).parquet(path).select(*[name for name, _ in layout])


#: Events of a user as the jobs exchange them.
EVENTS = (("uid", "string"), ("ts", "timestamp_ntz"), ("channel_name", "string"), ("program_name", "string"))


def write_events(rows: DataFrame, path: str, *, form: str = PARQUET, files: int = 0) -> None:
    """Live or shutdown records; in text their time has 14 characters."""
    if form == TEXT:
        rows = rows.withColumn("time_text", time_text(rows["ts"]))
        write_rows(rows, path, records.STREAM, form=TEXT, files=files)
    else:
        write_rows(rows, path, EVENTS, files=files)
