"""What a new period's summaries need of the past, kept in two tables under one folder.

``user_days`` has a row per user and day, in a directory per day, so that a batch reads its own days
and the period before. ``first_seen`` has each user's first day, stored by user: a batch shuffles
its own users to it, and the table itself is not shuffled.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.functions.calendar import Grain, shift_period
from airwave.operators.flows import bounds
from airwave.operators.reached import new_users, summary_of_batch
from airwave.sinks import viewers

USER_DAYS = "uid string, seconds long, day date"
FIRST_SEEN = "uid string, day date"


def user_days(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(USER_DAYS).parquet(f"{path}/user_days")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], USER_DAYS)


def first_seen(spark: SparkSession, path: str) -> DataFrame:
    return viewers.read(spark, f"{path}/first_seen", FIRST_SEEN, ("uid",))


def _add_first_seen(rows: DataFrame, path: str, buckets: int) -> None:
    viewers.add(rows, f"{path}/first_seen", FIRST_SEEN, ("uid",), buckets)


def begin(base: DataFrame, path: str, buckets: int = viewers.BUCKETS) -> None:
    """Users who count as reached before any day. Those that are stored already are left out."""
    spark = base.sparkSession
    known = base.select("uid", F.lit(None).cast("date").alias("day"))
    _add_first_seen(new_users(known, first_seen(spark, path)), path, buckets)


def extend(viewing: DataFrame, path: str, first, last, buckets: int = viewers.BUCKETS) -> None:
    """Add the viewing of the days from ``first`` to ``last``, rows (uid, day, seconds).

    Days that are stored already are replaced, and users keep their first day, so a batch that
    failed, or was done, can be run again. A batch before the last stored day is refused: its users'
    first days could be stored as later ones.
    """
    spark = viewing.sparkSession
    low, high = (F.lit(str(day)).cast("date") for day in (first, last))
    if not user_days(spark, path).filter(F.col("day") > high).isEmpty():
        raise ValueError(f"{path} holds days after {last}: batches must come in the order of time")
    inside = F.col("day").between(low, high)
    collapsed = (
        viewing.filter(inside & F.col("uid").isNotNull())
        .groupBy("uid", "day")
        .agg(F.sum("seconds").cast("long").alias("seconds"))
    )
    by_day = spark.sql("SELECT /*+ REBALANCE(day) */ uid, seconds, day FROM {rows}", rows=collapsed)
    (
        by_day.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(f"{path}/user_days")
    )
    batch = user_days(spark, path).filter(inside)
    _add_first_seen(new_users(batch, first_seen(spark, path)), path, buckets)


def is_first_period(spark: SparkSession, path: str, grain: Grain, day) -> bool:
    """Whether nothing is stored before the period that holds ``day``; looks at the days alone."""
    start, _ = bounds(grain, day, day)
    return user_days(spark, path).filter(F.col("day") < start).isEmpty()


def needed_days(spark: SparkSession, path: str, grain: Grain, first, last) -> DataFrame:
    """The stored days from the period before the one of ``first`` to the end of that of ``last``."""
    start, end = bounds(grain, first, last)
    low, high = shift_period(grain, start, -1), F.date_sub(shift_period(grain, end, 1), 1)
    return user_days(spark, path).filter(F.col("day").between(low, high))


def summary(spark: SparkSession, path: str, grain: Grain, first, last, seed_previous: DataFrame | None = None) -> DataFrame:
    """Summaries of the periods that ``first`` to ``last`` touch; the first one may be open since the
    batch before and is then given anew."""
    days = needed_days(spark, path, grain, first, last)
    return summary_of_batch(days, first_seen(spark, path), grain, first, last, seed_previous)
