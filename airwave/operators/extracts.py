"""Small extractions: seed users, channel lists, the prototype report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airwave.operators.kpi import with_type

SEED_USERS = 200_000
_STEPS = 1000


def least_users(users: DataFrame, n: int) -> DataFrame:
    """The ``n`` least distinct user ids, by number.

    A top-n alone would bring n rows of every partition to one task. So an approximate
    quantile, chosen with a margin above its error bound, first drops the users that
    cannot be among the first n; the exact top-n then sees little more than n rows.
    """
    number = F.col("_number")
    users = users.select("uid", F.col("uid").try_cast("long").alias("_number")).distinct()
    steps = F.array(*[F.lit(i / _STEPS) for i in range(_STEPS + 1)])
    # The quantiles' rank error is 1/10000; two steps of 1/1000 more are well above it.
    step = F.ceil(F.lit(n) / F.count(number) * _STEPS) + 2
    cut = users.agg(
        F.when(F.count(number) == 0, F.lit(0).cast("long"))
        .when(F.lit(n) * 2 >= F.count(number), F.max(number))
        .otherwise(F.get(F.percentile_approx(number, steps, 10000), step.cast("int")))
    )
    near = users.filter(number.isNull() | (number <= cut.scalar()))
    return near.orderBy(number.asc_nulls_last(), "uid").limit(n).select("uid")


def first_users(viewing: DataFrame, months: tuple[int, ...], n: int = SEED_USERS) -> DataFrame:
    """Seed users: the least ids among those active in any of the months."""
    return least_users(viewing.filter(F.col("month").isin(*months)), n)


def distinct_channels(viewing: DataFrame, after: int, before: int) -> DataFrame:
    """Channels seen in the open month interval."""
    month = F.col("month")
    return (
        viewing.filter((month > after) & (month < before)).select("channel_name").distinct()
    )


def sorted_dictionary(dictionary: DataFrame) -> DataFrame:
    """Distinct dictionary rows in order."""
    return dictionary.distinct().orderBy(*dictionary.columns)


def channel_by_frame(log: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Use of each channel per date and time frame, beside the totals of the frame.

    Takes (uid, date, time_frame, channel_name, remain_time). Each row stands for its channel and for
    its frame as a whole, told apart by ``total``, a grouping key: rows collapse to one per frame,
    channel (or none) and user, and one shuffle sums both levels.
    """
    frame = ["date", "time_frame"]
    name = F.col("channel_name")
    both = [
        F.struct(F.lit(total).alias("total"), (F.lit(None).cast("string") if total else name).alias("channel_name"))
        for total in (False, True)
    ]
    levels = log.select(*frame, "uid", "remain_time", F.explode(F.array(*both)).alias("l"))
    per_user = levels.select(*frame, "uid", "remain_time", "l.*").groupBy(*frame, "total", "channel_name", "uid").agg(
        F.sum("remain_time").alias("used"), F.count("remain_time").alias("n")
    )
    sums = per_user.groupBy(*frame, "total", "channel_name").agg(
        F.sum("used").alias("used"), F.sum("n").alias("n"), F.count("uid").alias("user_num")
    )
    # One row per channel of a frame: the totals come beside them.
    whole = F.max(F.when(F.col("total"), F.struct("used", "user_num"))).over(Window.partitionBy(*frame))
    channels = sums.withColumn("t", whole).filter(~F.col("total")).select(
        *frame,
        "channel_name",
        (F.col("used") / F.col("n")).alias("time_use_avg"),
        F.col("used").alias("time_use_sum"),
        "user_num",
        F.col("t.used").alias("all_time_use"),
        F.col("t.user_num").alias("all_user_num"),
    )
    return with_type(channels, dictionary).select(
        *frame,
        "channel_name",
        "channel_type",
        "time_use_avg",
        "time_use_sum",
        "user_num",
        "all_time_use",
        "all_user_num",
    )
