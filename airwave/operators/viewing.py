"""From events to viewing records: shutdowns, dwell times, hourly pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.functions.calendar import month_key, week_key, with_calendar_keys
from airwave.functions.text import tail_digits
from airwave.operators.neighbours import with_next, with_next_stored, with_previous
from airwave.operators.skew import heavy_keys

# The mark of a shutdown record, and the dwell bounds in seconds.
SHUTDOWN = "_"
SHORTEST, LONGEST = 5, 36000
HEARTBEAT_MINUTES = 10

VIEWING_KEYS = ["uid", "month", "week", "day", "hour", "channel_name", "program_name"]


def off_time(last: Column, draw: int | None = None) -> Column:
    """When a box went off whose last power record was at ``last``: within one heartbeat."""
    if draw is None:
        seed = F.coalesce(tail_digits(F.col("uid")), F.lit(0)) * 31 + F.unix_timestamp(last)
    else:
        seed = F.xxhash64("uid", last, F.lit(draw))
    offset = F.pmod(seed, F.lit(HEARTBEAT_MINUTES)).cast("int")
    return F.timestamp_add("MINUTE", offset, last)


def shutdown_times(
    power: DataFrame,
    tie: list[str] | None = None,
    draw: int | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """One shutdown record per switch-on that follows another power record.

    The box went off within one heartbeat after the last record before the switch-on. The
    offset of 0-9 minutes is a hash of user and time, so a rerun or a retried task gives the
    same records; another ``draw`` gives other offsets, as random as they need to be.

    Takes (uid, ts, opens, ``tie`` columns) and keeps the ``tie`` columns. ``heavy`` is the
    list of heavy users, found from the rows if not given.
    """
    tie = tie or []
    before = with_previous(power, "off", ["ts", "opens", *tie], heavy)
    return before.filter(F.col("opens") & F.col("off").isNotNull()).select(
        "uid",
        off_time(F.col("off"), draw).alias("ts"),
        F.lit(SHUTDOWN).alias("channel_name"),
        F.lit(SHUTDOWN).alias("program_name"),
        *tie,
    )


def dwell_times(
    live: DataFrame,
    shutdowns: DataFrame,
    tie: list[str] | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Seconds from each live record to the user's next record, live or shutdown.

    A user's last record has no dwell. Records at the same second order by kind (live
    first) and then by the ``tie`` columns, by default the names. Adds ``slot``, by which
    the rows are placed (see ``neighbours``). Heavy users, if not given, are those with
    many live records.
    """
    tie = tie or ["channel_name", "program_name"]
    heavy = heavy_keys(live) if heavy is None else heavy
    stream = live.withColumn("off", F.lit(0)).unionByName(shutdowns.withColumn("off", F.lit(1)))
    return _dwell(with_next(stream, "next_ts", ["ts", "off", *tie], heavy))


def dwell_of_stored(stream: DataFrame, tie: list[str] | None = None) -> DataFrame:
    """``dwell_times`` of live (``off`` 0) and shutdown records (1) stored by user, without a shuffle."""
    tie = tie or ["channel_name", "program_name"]
    return _dwell(with_next_stored(stream, "next_ts", ["ts", "off", *tie]))


def _dwell(following: DataFrame) -> DataFrame:
    return within_bounds(following.filter(F.col("off") == 0).drop("off"))


def within_bounds(rows: DataFrame) -> DataFrame:
    """Add ``seconds`` from ``ts`` to ``next_ts`` and keep the rows where they count as viewing."""
    seconds = F.unix_timestamp("next_ts") - F.unix_timestamp("ts")
    timed = rows.withColumn("seconds", seconds)
    return timed.filter(F.col("seconds").between(SHORTEST, LONGEST)).drop("next_ts")


def viewing_of(
    live: DataFrame, power: DataFrame, tie: list[str] | None = None
) -> DataFrame:
    """Live and power records to hourly viewing; heavy users are found once for both."""
    heavy = heavy_keys(live.select("uid").unionByName(power.select("uid")))
    off = shutdown_times(power, tie, heavy=heavy)
    return hourly_viewing(dwell_times(live, off, tie, heavy))


def hourly_viewing(dwell: DataFrame) -> DataFrame:
    """Sum the dwell of a user per start hour, channel and program.

    A slot lies within one hour or holds all rows of a user, so grouping by it as well
    changes no sum and spares a shuffle.
    """
    return (
        with_calendar_keys(dwell)
        .groupBy("slot", *VIEWING_KEYS)
        .agg(F.sum("seconds").alias("seconds"))
        .drop("slot")
    )


def split_hours(viewing: DataFrame) -> DataFrame:
    """Cut records of more than an hour into pieces of at most 3600 s.

    Pieces start at the top of the record's hour and carry the calendar keys of their own
    hour. Equal keys may repeat; readers sum them.
    """
    pieces = F.sequence(
        F.lit(0), F.greatest(F.ceil(F.col("seconds") / 3600), F.lit(1)).cast("int") - 1
    )
    hour = F.col("hour") + F.col("piece")
    cut = (
        viewing.withColumn("piece", F.explode(pieces))
        .withColumns(
            {
                "day": F.date_add("day", F.floor(hour / 24).cast("int")),
                "hour": (hour % 24).cast("int"),
                "seconds": F.least(F.lit(3600), F.col("seconds") - 3600 * F.col("piece")),
            }
        )
        .drop("piece")
    )
    keys = {"month": month_key(F.col("day")), "week": week_key(F.col("day"))}
    return cut.withColumns(keys).select(*VIEWING_KEYS, "seconds")
