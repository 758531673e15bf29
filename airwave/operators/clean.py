"""Validation, clean-up and routing of raw log records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.functions.text import clean_channel, known_or_mark, log_time
from airwave.sources.logs import HEARTBEAT, LIVE, OPEN, key_positions

# First and last month the jobs accept.
FIRST_MONTH, LAST_MONTH = 201604, 201609


def _sound(months: tuple[int, int]) -> Column:
    """Time of 14 characters in the month range, user id of more than 6."""
    month = F.substring("time_text", 1, 6).try_cast("int")
    return (
        (F.length("time_text") == 14)
        & (F.length("uid") > 6)
        & month.between(F.lit(months[0]), F.lit(months[1]))
    )


def _starts(code: str) -> Column:
    """Lines of one event code, told by their beginning: needs no split of the others."""
    return F.col("line").startswith(f"{code};")


def _timed(records: DataFrame) -> DataFrame:
    return records.withColumn("ts", log_time(F.col("time_text"))).filter(F.col("ts").isNotNull())


def filter_live(
    log: DataFrame, months: tuple[int, int] = (FIRST_MONTH, LAST_MONTH)
) -> DataFrame:
    """Distinct, cleaned live records of a parsed log (11 fields each)."""
    kept = log.filter(_starts(LIVE) & (F.col("n_fields") == 11) & _sound(months))
    return (
        _timed(kept)
        .select(
            "uid",
            "ts",
            clean_channel(F.col("channel_raw")).alias("channel_name"),
            known_or_mark(F.col("program_raw")).alias("program_name"),
        )
        .distinct()
    )


def filter_power(
    log: DataFrame, months: tuple[int, int] = (FIRST_MONTH, LAST_MONTH)
) -> DataFrame:
    """Heartbeat and switch-on records of a parsed log, of any field count."""
    kept = log.filter((_starts(HEARTBEAT) | _starts(OPEN)) & _sound(months))
    return _timed(kept).select("uid", "ts", (F.col("code") == OPEN).alias("opens"))


def monthly_users(
    log: DataFrame, months: tuple[int, int] = (FIRST_MONTH, LAST_MONTH)
) -> DataFrame:
    """Users per month under the relaxed rule: 9 fields are enough."""
    kept = log.filter(_starts(LIVE) & (F.col("n_fields") >= 9) & _sound(months))
    return (
        kept.select("uid", F.substring("time_text", 1, 6).cast("int").alias("month"))
        .groupBy("month")
        .agg(F.count_distinct("uid").alias("user_num"))
    )


def route_events(log: DataFrame) -> DataFrame:
    """Pick the two key fields of each line by its event code.

    The routing table is a constant of a few dozen rows, so it is broadcast. Lines of
    other codes, and keys that are empty, ``0`` or hold a tab, drop out.
    """
    routes = F.broadcast(key_positions(log.sparkSession))
    routed = log.join(routes, "code").select(
        F.get("fields", F.col("first")).alias("key_1"),
        F.get("fields", F.col("second")).alias("key_2"),
        "line",
    )
    for name in ("key_1", "key_2"):
        key = F.col(name)
        routed = routed.filter(~key.isin("", "0") & ~key.contains("\t"))
    return routed
