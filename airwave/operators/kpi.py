"""Audience KPIs, one code path for every grain and report level.

The order of work keeps hot channels and hot periods harmless: rows first collapse to one
per (period, item, user), the dictionary joins after that, and every count of distinct
users is a two-step aggregation spread over the users.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.functions.calendar import HOUR, Grain
from airwave.functions.ratios import minutes, ratio, shown, user_index
from airwave.operators.skew import lookup
from airwave.sources.records import unique_dictionary

WEIGHT = 10000
LONGEST_REQUEST = 60


@dataclass(frozen=True)
class Business:
    """What differs between the live and the demand reports."""

    name: str
    user_type: int
    item: str
    kind: str
    prefix: str
    kinds: tuple[str, ...]


# The user_type codes and the two reported types of each business.
BOTH = 0
LIVE = Business("live", 1, "channel_name", "channel_type", "channel", ("央视频道", "卫视频道"))
DEMAND = Business("demand", 2, "show_name", "show_type", "show", ("电影", "电视剧"))


def with_type(viewing: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Left lookup of the type; unknown names get null."""
    spread = "uid" if "uid" in viewing.columns else None
    return lookup(viewing, unique_dictionary(dictionary), "left", spread)


def distinct_requests(viewing: DataFrame, grain: Grain) -> DataFrame:
    """Demand rows as the reports see them: equal rows of the used columns count once."""
    columns = ["uid", *grain.keys, "seconds", "show_name"]
    if grain is HOUR:
        columns.append("flag")
    return viewing.select(*columns).distinct()


def counted_requests(viewing: DataFrame, grain: Grain) -> DataFrame:
    """The distinct requests of a period, with their number of rows and of flagged rows.

    Report, flows and show counts all read these rows. The filter drops nothing: it makes each
    reader ask for both counts, since readers of other columns could not share the shuffle.
    """
    columns = ["uid", *grain.keys, "seconds", "show_name"]
    counts = [F.count("*").alias("n"), F.count_if("flag").alias("n_flagged")]
    return viewing.groupBy(*columns).agg(*counts).filter("n >= n_flagged")


def per_user(viewing: DataFrame, grain: Grain, items: list[str]) -> DataFrame:
    """Seconds per period, item and user.

    The reports start with this. A caller that needs the same rows for the period summary
    as well can do it beforehand: Spark then does not shuffle again inside the report, and
    both readers share the one shuffle.
    """
    return viewing.groupBy(*grain.keys, *items, "uid").agg(F.sum("seconds").alias("seconds"))


def hour_totals(viewing: DataFrame, cover: DataFrame, shows: str | None = None) -> DataFrame:
    """Users, minutes (and distinct shows) per hour, with the users reached by that day.

    ``cover`` has one row per day of the calendar (day, cover_user_num): a bound on its
    size that does not move with the viewing data; the engine broadcasts what it finds small.
    """
    counts = [
        F.count_distinct("uid").alias("user_num"),
        minutes(F.sum("seconds")).alias("time_in_use"),
    ]
    if shows:
        counts.append(F.count_distinct(shows).alias("all_show_num"))
    totals = viewing.groupBy(*HOUR.keys).agg(*counts)
    return totals.join(cover.select("day", "cover_user_num"), "day", "left")


def request_times(viewing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the request flag, per key; keys without any are absent."""
    return viewing.filter("flag").groupBy(*keys).agg(F.count("*").alias("request_times"))


def reported(
    dictionary: DataFrame, business: Business, kinds: tuple[str, ...] | None
) -> DataFrame:
    """Names of the reported types, one type per name."""
    unique = unique_dictionary(dictionary)
    return unique.filter(F.col(business.kind).isin(*(kinds or business.kinds)))


def _measures(
    grouped: DataFrame,
    totals: DataFrame,
    grain: Grain,
    business: Business,
    names: list[str],
    prefix: str,
    weight: float,
) -> DataFrame:
    """Join the period totals and lay out the KPI columns.

    ``totals`` has one row per period (at most 24 per day of the calendar), whatever the
    size of the data; the engine broadcasts what it finds small.
    """
    return with_totals(grouped.join(totals, list(grain.keys), "left"), grain, business, names, prefix, weight)


def with_totals(
    joined: DataFrame, grain: Grain, business: Business, names: list[str], prefix: str, weight: float
) -> DataFrame:
    """The KPI columns of groups that stand beside their period's totals."""
    mine = minutes(F.col("group_seconds"))
    users, cover = F.col("group_users"), F.col("cover_user_num")
    all_users, all_minutes = F.col("user_num"), F.col("time_in_use")
    share = shown(ratio(mine, all_minutes)).alias("market_pct")
    # The hour reports measure coverage against the users reached, the others against the
    # users of the period.
    covered = shown(ratio(users, cover if grain is HOUR else all_users)).alias("cover_pct")
    columns = [
        *grain.keys,
        *names,
        shown(user_index(mine, grain.minutes, cover, weight)).alias("user_index"),
        *([share, covered] if business is LIVE else [covered, share]),
        shown(ratio(mine, users)).alias("time_in_use_avg"),
        shown(mine).alias(f"{prefix}_time_in_use"),
        users.alias(f"{prefix}_user_num"),
    ]
    if "group_items" in joined.columns:
        columns.append(shown(ratio(F.col("group_items"), F.col("all_show_num"))).alias("show_num_pct"))
    return joined.select(*columns, shown(all_minutes).alias("time_in_use"), all_users)


def type_report(
    viewing: DataFrame,
    dictionary: DataFrame,
    totals: DataFrame,
    grain: Grain,
    business: Business,
    *,
    kinds: tuple[str, ...] | None = None,
    weight: float = WEIGHT,
) -> DataFrame:
    """KPIs per period and type, for the reported types."""
    known = reported(dictionary, business, kinds)
    counts = [
        F.count_distinct("uid").alias("group_users"),
        F.sum("seconds").alias("group_seconds"),
    ]
    if business is DEMAND:
        counts.append(F.count_distinct(business.item).alias("group_items"))
    typed = lookup(per_user(viewing, grain, [business.item]), known)
    grouped = typed.groupBy(*grain.keys, business.kind).agg(*counts)
    return _measures(grouped, totals, grain, business, [business.kind], business.prefix, weight)


def item_report(
    viewing: DataFrame,
    dictionary: DataFrame,
    totals: DataFrame,
    grain: Grain,
    business: Business,
    *,
    kinds: tuple[str, ...] | None = None,
    weight: float = WEIGHT,
    programs: bool = False,
) -> DataFrame:
    """KPIs per period and channel or show; with ``programs`` per channel and program.

    The dictionary joins the grouped rows: one per period and item, so no name is hot.
    """
    known = reported(dictionary, business, kinds)
    items = [business.item] + (["program_name"] if programs else [])
    grouped = (
        per_user(viewing, grain, items)
        .groupBy(*grain.keys, *items)
        .agg(F.count("uid").alias("group_users"), F.sum("seconds").alias("group_seconds"))
        .join(known, business.item)
    )
    names = [business.item, business.kind]
    prefix = business.prefix
    if programs:
        names.insert(0, F.col("program_name").alias("show_name"))
        prefix = "show"
    return _measures(grouped, totals, grain, business, names, prefix, weight)


def ranked(report: DataFrame, ties: list[str]) -> DataFrame:
    """Highest user index first: a range-partitioned sort, with ``ties`` to settle it."""
    return report.orderBy(F.desc("user_index"), *ties)


def summary_report(summary: DataFrame, grain: Grain, business: Business) -> DataFrame:
    """User overview of each day, week or month; every row of ``summary`` is shown."""
    users, used = F.col("user_num"), F.col("time_in_use")
    last = F.col("last_user_num")
    if business is DEMAND:
        requests = [
            F.col("request_times"),
            shown(ratio(F.col("request_times"), users)).alias("request_times_avg"),
            shown(ratio(used, F.col("request_times"))).alias("request_one"),
        ]
    else:
        requests = no_requests()
    return summary.select(
        *grain.keys,
        F.lit(business.user_type).alias("user_type"),
        "user_num",
        shown(ratio(users, F.col("cover_user_num"))).alias("cover_pct"),
        shown(ratio(users - last, last)).alias("growth_pct"),
        "user_in_num",
        "user_out_num",
        shown(used).alias("time_in_use"),
        shown(ratio(used, users)).alias("time_in_use_avg"),
        *requests,
    )


def no_requests() -> list[Column]:
    """The request columns of reports that have none."""
    return [
        F.lit(0).cast("long").alias("request_times"),
        F.lit(0.0).alias("request_times_avg"),
        F.lit(0.0).alias("request_one"),
    ]


def hour_summary_report(
    viewing: DataFrame, cover: DataFrame, business: Business
) -> DataFrame:
    """User overview of each hour.

    Demand hours without a request show null requests and 0 minutes per request, and
    minutes per request stop at 60.
    """
    counts = [F.count_distinct("uid").alias("user_num"), F.sum("seconds").alias("seconds")]
    if business is DEMAND:
        counts.append(F.count_if("flag").alias("n_requests"))
    totals = (
        viewing.groupBy(*HOUR.keys)
        .agg(*counts)
        .join(cover.select("day", "cover_user_num"), "day", "left")
    )
    requests = F.col("n_requests") if business is DEMAND else F.lit(0).cast("long")
    totals = totals.withColumns({"time_in_use": minutes(F.col("seconds")), "requests": requests})
    return hour_summary_shown(totals, business)


def hour_summary_shown(totals: DataFrame, business: Business) -> DataFrame:
    """The overview's columns, from user_num, time_in_use, cover_user_num and requests of each hour."""
    users, used = F.col("user_num"), F.col("time_in_use")
    if business is DEMAND:
        count = F.nullif(F.col("requests"), F.lit(0))
        each = shown(F.coalesce(ratio(used, count), F.lit(0.0)))
        requests = [
            count.alias("request_times"),
            shown(ratio(count, users)).alias("request_times_avg"),
            F.least(each, F.lit(float(LONGEST_REQUEST))).alias("request_one"),
        ]
    else:
        requests = no_requests()
    return totals.select(
        *HOUR.keys,
        F.lit(business.user_type).alias("user_type"),
        "user_num",
        shown(ratio(users, F.col("cover_user_num"))).alias("cover_pct"),
        shown(used).alias("time_in_use"),
        shown(ratio(used, users)).alias("time_in_use_avg"),
        *requests,
    )
