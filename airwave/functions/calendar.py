"""Calendar grains and the keys derived from a time.

A period is held as the date of its first day, so that the previous period is date
arithmetic and never ``key - 1`` (which breaks in January and at week 1). Reports show
the key: a date, ``yyyyMM``, or ISO year * 100 + ISO week.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grain:
    """A report grain: its key columns and its length in minutes."""

    name: str
    keys: tuple[str, ...]
    minutes: int


HOUR = Grain("hour", ("day", "hour"), 60)
DAY = Grain("day", ("day",), 60 * 24)
WEEK = Grain("week", ("week",), 60 * 24 * 7)
MONTH = Grain("month", ("month",), 60 * 24 * 30)

GRAINS = {grain.name: grain for grain in (HOUR, DAY, WEEK, MONTH)}

_STEP = {"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month"}


def period_start(grain: Grain, day: Column) -> Column:
    """First day of the period that holds ``day``."""
    if grain is DAY:
        return day
    return F.trunc(day, grain.name).cast("date")


def shift_period(grain: Grain, start: Column, n: int) -> Column:
    """First day of the period ``n`` periods later."""
    if grain is MONTH:
        return F.add_months(start, n)
    return F.date_add(start, n * (7 if grain is WEEK else 1))


def month_key(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def week_key(day: Column) -> Column:
    return (F.date_part(F.lit("YEAROFWEEK"), day) * 100 + F.weekofyear(day)).cast("int")


def period_key(grain: Grain, start: Column) -> Column:
    """The key that reports show for a period."""
    if grain is WEEK:
        return week_key(start)
    if grain is MONTH:
        return month_key(start)
    return start


def week_monday(key: Column) -> Column:
    """Monday of an ISO week key; 4 January always lies in week 1."""
    first = F.trunc(F.make_date(F.floor(key / 100).cast("int"), F.lit(1), F.lit(4)), "week")
    return F.date_add(first, ((key % 100) - 1).cast("int") * 7)


def start_of_key(grain: Grain, key: Column) -> Column:
    """First day of the period with that key."""
    if grain is WEEK:
        return week_monday(key)
    if grain is MONTH:
        return F.make_date(F.floor(key / 100).cast("int"), (key % 100).cast("int"), F.lit(1))
    return key


def shift_week(df: DataFrame, n: int, column: str = "week") -> DataFrame:
    """Move every week key by ``n`` weeks, across year ends too."""
    moved = week_key(F.date_add(week_monday(F.col(column)), 7 * n))
    return df.withColumn(column, moved)


def with_calendar_keys(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add ``month``, ``week``, ``day`` and ``hour`` of a time column."""
    day = F.to_date(ts)
    return df.withColumns(
        {
            "month": month_key(day),
            "week": week_key(day),
            "day": day,
            "hour": F.hour(ts).cast("int"),
        }
    )


def dense_calendar(spark: SparkSession, grain: Grain, first: Column, last: Column) -> DataFrame:
    """Every period from the one holding ``first`` to the one holding ``last``."""
    steps = F.sequence(
        period_start(grain, first), period_start(grain, last), F.expr(_STEP[grain.name])
    )
    return spark.range(1).select(F.explode(steps).alias("period"))


def whole_seconds(ts: Column) -> Column:
    """Cut a time without zone to whole seconds, the precision of the logs."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.unix_timestamp(ts), epoch)


def between_keys(df: DataFrame, column: str, low, high) -> DataFrame:
    """Closed range on a period key; a plain comparison, so it reaches the Parquet scan."""
    return df.filter(F.col(column).between(F.lit(low), F.lit(high)))
