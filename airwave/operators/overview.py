"""Live and demand together. A viewer of both businesses counts in both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.functions.calendar import HOUR, WEEK, Grain, shift_week
from airwave.functions.ratios import ratio, shown
from airwave.operators.kpi import BOTH, no_requests

# Fixed value: demand weeks arrive one too high.
DEMAND_WEEK_SHIFT = -1

ADDED = ["user_num", "cover_user_num", "user_in_num", "user_out_num", "last_user_num",
         "time_in_use"]


def _added(live: DataFrame, demand: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    both = live.select(*keys, *columns).alias("l").join(
        demand.select(*keys, *columns).alias("d"), keys
    )
    sums = [(F.col(f"l.{c}") + F.col(f"d.{c}")).alias(c) for c in columns]
    return both.select(*keys, *sums)


def overview_report(
    live: DataFrame, demand: DataFrame, grain: Grain, week_shift: int = DEMAND_WEEK_SHIFT
) -> DataFrame:
    """Sums of the live and demand summaries of the periods both have, and their ratios."""
    if grain is WEEK and week_shift:
        demand = shift_week(demand, week_shift)
    sums = _added(live, demand, list(grain.keys), ADDED)
    users, last, used = F.col("user_num"), F.col("last_user_num"), F.col("time_in_use")
    return sums.select(
        *grain.keys,
        F.lit(BOTH).alias("user_type"),
        "user_num",
        shown(ratio(users, F.col("cover_user_num"))).alias("cover_pct"),
        shown(ratio(users - last, last)).alias("growth_pct"),
        "user_in_num",
        "user_out_num",
        shown(used).alias("time_in_use"),
        shown(ratio(used, users)).alias("time_in_use_avg"),
        *no_requests(),
    )


def hour_overview_report(live: DataFrame, demand: DataFrame) -> DataFrame:
    """Minutes of both hour reports; users and coverage are not shown at this grain."""
    sums = _added(live, demand, list(HOUR.keys), ["user_num", "time_in_use"])
    used = F.col("time_in_use")
    return sums.select(
        *HOUR.keys,
        F.lit(BOTH).alias("user_type"),
        F.lit(0).cast("long").alias("user_num"),
        F.lit(0.0).alias("cover_pct"),
        shown(used).alias("time_in_use"),
        shown(ratio(used, F.col("user_num"))).alias("time_in_use_avg"),
        *no_requests(),
    )
