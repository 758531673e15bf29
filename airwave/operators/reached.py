"""Users reached so far, from a table of each user's first day instead of all history.

A user's first day is a date, or null for users who count as reached before any day. A new batch
adds the users that the table does not have; its days are later than those of the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airwave.functions.calendar import Grain, dense_calendar, period_key, period_start, shift_period
from airwave.operators.flows import bounds, period_summary


def first_days(rows: DataFrame) -> DataFrame:
    """(uid, day): the first day of each user."""
    return rows.filter(F.col("uid").isNotNull()).groupBy("uid").agg(F.min("day").alias("day"))


def new_users(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``first_days`` of the users that are not ``known``; one row a user on both sides of the join."""
    return first_days(rows).join(known.select("uid"), "uid", "left_anti")


def cover(first_seen: DataFrame, grain: Grain, first, last) -> DataFrame:
    """(grain's key, cover_user_num) for each period from ``first`` to ``last``, empty ones too.

    Users are counted per period before anything else; what was before the first period is one row.
    """
    start, end = bounds(grain, first, last)
    before = shift_period(grain, start, -1)
    period = F.greatest(F.coalesce(period_start(grain, F.col("day")), before), before)
    new = first_seen.select(period.alias("period")).groupBy("period").agg(F.count("*").alias("n"))
    zeros = dense_calendar(first_seen.sparkSession, grain, before, end).select(
        "period", F.lit(0).cast("long").alias("n")
    )
    counts = reduce(DataFrame.unionByName, [new, zeros]).groupBy("period").agg(F.sum("n").alias("n"))
    # One row per calendar period.
    so_far = counts.withColumn("cover_user_num", F.sum("n").over(Window.orderBy("period")))
    inside = so_far.filter(F.col("period").between(start, end))
    return inside.select(period_key(grain, F.col("period")).alias(grain.name), "cover_user_num")


def summary_of_batch(
    days: DataFrame, first_seen: DataFrame, grain: Grain, first, last, seed_previous: DataFrame | None = None
) -> DataFrame:
    """``flows.period_summary`` of live rows for the periods that ``first`` to ``last`` touch.

    ``days`` are rows (uid, day, seconds) from the period before the first one on; older ones are
    not needed. ``first_seen`` tells who was reached.
    """
    flows = period_summary(days, grain, first, last, seed_previous=seed_previous, look_back=True)
    columns = flows.columns
    reached = cover(first_seen, grain, first, last)
    # Two tables of one row per calendar period.
    return flows.drop("cover_user_num").join(reached, grain.name).select(*columns)
