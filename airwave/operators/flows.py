"""Users per period: active, reached so far, flowing in, flowing out.

All periods are computed in one pass. Viewing rows collapse to one row per user and
period before anything is ordered, so a user's group is bounded by the calendar.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airwave.functions.calendar import (
    DAY,
    MONTH,
    WEEK,
    Grain,
    dense_calendar,
    period_key,
    period_start,
    shift_period,
    start_of_key,
)
from airwave.functions.ratios import minutes

ACTIVE, PREVIOUS, KNOWN = "active", "previous", "known"


def bounds(grain: Grain, first, last) -> tuple[Column, Column]:
    ends = (day if isinstance(day, Column) else F.lit(str(day)).cast("date") for day in (first, last))
    start, end = (period_start(grain, day) for day in ends)
    return start, end


def _one(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("long")


def flow_marks(grain: Grain, line) -> dict[str, Column]:
    """What a user's state in a period counts for, 0 or 1: a user, reached for the first time, entering,
    leaving. ``line`` is the window of the user's states (period, role) in order."""
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    role, period = F.col("role"), F.col("period")
    earlier, later = F.lag("period").over(line), F.lead("period").over(line)
    counting = F.when(role != PREVIOUS, 1)
    return {
        "users": _one(role != KNOWN),
        "reached": _one((role != PREVIOUS) & (F.count(counting).over(so_far) == 1)),
        "entering": _one((role == ACTIVE) & (earlier.isNull() | (earlier != shift_period(grain, period, -1)))),
        "leaving": _one((role != KNOWN) & (later.isNull() | (later != shift_period(grain, period, 1)))),
    }


def period_summary(
    viewing: DataFrame,
    grain: Grain,
    first,
    last,
    *,
    seed_cover: DataFrame | None = None,
    seed_previous: DataFrame | None = None,
    look_back: bool = False,
    demand: bool = False,
    own_key: bool = False,
    trimmed: bool = False,
    counted: bool = False,
) -> DataFrame:
    """One row per period of the calendar from ``first`` to ``last``, empty ones too.

    Takes (uid, day, seconds), and with ``demand`` also (show_name, flag). Columns: the
    grain's key, user_num, cover_user_num (users seen up to the period), user_in_num
    (absent in the period before), user_out_num (gone since the period before),
    last_user_num, time_in_use in minutes; with ``demand`` also request_times and
    all_show_num.

    ``seed_cover`` holds users who count as reached before the first period and
    ``seed_previous`` those who were active in the period just before it. ``look_back``
    takes the latter from the viewing rows themselves; such users are not reached by that.
    ``own_key`` takes periods from the rows' key of the grain instead of their ``day``: for
    rows summed per period, or for sources that number weeks in another way. ``trimmed``
    rows all lie in the calendar: no filter is pushed below them, so that a shuffle they
    come from can be shared with other readers. ``counted`` rows stand for ``n`` equal rows
    each, ``n_flagged`` of them with the flag (see ``kpi.counted_requests``).
    """
    spark = viewing.sparkSession
    start, end = bounds(grain, first, last)
    before, long_before = shift_period(grain, start, -1), shift_period(grain, start, -2)
    period = start_of_key(grain, F.col(grain.name)) if own_key else period_start(grain, F.col("day"))
    rows = viewing.withColumn("period", period)
    inside = rows if trimmed else rows.filter(F.col("period").between(start, end))

    seconds, requests = F.sum("seconds"), F.lit(0).cast("long")
    if counted:
        seconds, requests = F.sum(F.col("seconds") * F.col("n")), F.sum("n_flagged")
    elif demand:
        requests = F.count_if("flag")
    parts = [
        inside.groupBy("uid", "period").agg(
            seconds.alias("seconds"),
            requests.alias("requests"),
            F.lit(ACTIVE).alias("role"),
        )
    ]
    previous = [seed_previous.select("uid")] if seed_previous is not None else []
    if look_back:
        previous.append(rows.filter(F.col("period") == before).select("uid"))
    seeds = []
    if previous:
        seeds.append((reduce(DataFrame.unionByName, previous), before, PREVIOUS))
    if seed_cover is not None:
        # One period earlier still, where it cannot be taken for the previous period.
        seeds.append((seed_cover.select("uid"), long_before, KNOWN))
    for uids, period, role in seeds:
        parts.append(
            uids.distinct().select(
                "uid",
                period.alias("period"),
                F.lit(0).cast("long").alias("seconds"),
                F.lit(0).cast("long").alias("requests"),
                F.lit(role).alias("role"),
            )
        )
    states = reduce(DataFrame.unionByName, parts)

    marks = flow_marks(grain, Window.partitionBy("uid").orderBy("period"))
    flows = states.select(
        "period",
        *[mark.alias(name) for name, mark in marks.items()],
        "seconds",
        "requests",
        F.lit(0).cast("long").alias("shows"),
    )

    # Empty periods, and shows per period, join in as rows of zeros: no join is needed.
    zero = F.lit(0).cast("long")
    names = ["users", "reached", "entering", "leaving", "seconds", "requests", "shows"]
    calendar = dense_calendar(spark, grain, long_before, end)
    pieces = [flows, calendar.select("period", *[zero.alias(n) for n in names])]
    if demand:
        shows = inside.groupBy("period").agg(F.count_distinct("show_name").alias("shows"))
        pieces.append(
            shows.select("period", *[zero.alias(n) for n in names[:-1]], "shows")
        )
    counts = (
        reduce(DataFrame.unionByName, pieces)
        .groupBy("period")
        .agg(*[F.sum(n).alias(n) for n in names])
    )

    # From here on there is one row per calendar period.
    run = Window.orderBy("period")
    columns = [
        F.col("users").alias("user_num"),
        F.sum("reached").over(run).alias("cover_user_num"),
        F.col("entering").alias("user_in_num"),
        F.lag("leaving").over(run).alias("user_out_num"),
        F.lag("users").over(run).alias("last_user_num"),
    ]
    if demand:
        columns.append(F.col("requests").alias("request_times"))
    columns.append(minutes(F.col("seconds")).alias("time_in_use"))
    if demand:
        columns.append(F.col("shows").alias("all_show_num"))
    summary = counts.select("period", *columns).filter(F.col("period") >= start)
    key = period_key(grain, F.col("period")).alias(grain.name)
    return summary.select(key, *[c for c in summary.columns if c != "period"])


def tagged(summary: DataFrame, grain: Grain) -> DataFrame:
    """A summary as rows of the common summary table: (grain, period text, ...)."""
    return summary.select(
        F.lit(grain.name).alias("grain"),
        F.col(grain.name).cast("string").alias("period"),
        *[c for c in summary.columns if c != grain.name],
    )


def all_summaries(viewing: DataFrame, first, last, **options) -> DataFrame:
    """Day, week and month summaries as one table.

    Live rows first collapse to one per user and day, a shuffle that all three grains
    read. Demand rows do not: their show counts need the rows themselves.
    """
    if not options.get("demand"):
        viewing = viewing.groupBy("uid", "day").agg(F.sum("seconds").alias("seconds"))
    parts = [
        tagged(period_summary(viewing, grain, first, last, **options), grain)
        for grain in (DAY, WEEK, MONTH)
    ]
    return reduce(DataFrame.unionByName, parts)


def users_by(viewing: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct users per key."""
    return viewing.groupBy(*keys).agg(F.count_distinct("uid").alias("user_num"))


def shows_by(viewing: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct shows per key."""
    return viewing.groupBy(*keys).agg(F.count_distinct("show_name").alias("show_num"))


def moved_users(viewing: DataFrame, grain: Grain = DAY, *, entering: bool = True) -> DataFrame:
    """The users themselves behind the in-flow, or behind the out-flow, of each period.

    An anti-join of the (user, period) pairs with the same pairs one period on or back;
    both sides are distinct and joined on user and period, so no key is hot.
    """
    pairs = viewing.select(
        "uid", period_start(grain, F.col("day")).alias("period")
    ).distinct()
    moved = pairs.select(
        "uid", shift_period(grain, F.col("period"), 1).alias("period")
    )
    now, other = (pairs, moved) if entering else (moved, pairs)
    return now.join(other, ["uid", "period"], "left_anti").select(
        "uid", period_key(grain, F.col("period")).alias(grain.name)
    )
