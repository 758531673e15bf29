"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.functions.calendar import (
    DAY,
    GRAINS,
    HOUR,
    MONTH,
    WEEK,
    Grain,
    between_keys,
    month_key,
    shift_week,
    with_calendar_keys,
)
from airwave.functions.text import clean_channel, known_or_mark, tsv_lines
from airwave.operators import (
    clean,
    extracts,
    flows,
    kpi,
    layout,
    levels,
    overview,
    reached,
    timelines,
    viewing,
)
from airwave.session import saved
from airwave.sources import logs, records, tables

Query = Callable[[SparkSession, str], DataFrame]

TIE = ["event_id"]


# Calendars: from the first to the last day of the tables' own times.

def live_days(spark: SparkSession, d: str) -> tuple[Column, Column]:
    return tables.first_and_last(spark, d, "events", "ts")


def demand_days(spark: SparkSession, d: str) -> tuple[Column, Column]:
    return tables.first_and_last(spark, d, "orders", "o_orderdate")


def log_months(spark: SparkSession, d: str) -> tuple[Column, Column]:
    first, last = live_days(spark, d)
    return month_key(first), month_key(last)


# Tables that the queries start from.

def live_hours(spark: SparkSession, d: str) -> DataFrame:
    return viewing.viewing_of(tables.live_log(spark, d), tables.power_log(spark, d), TIE)


def live_pieces(spark: SparkSession, d: str) -> DataFrame:
    return viewing.split_hours(live_hours(spark, d))


def parsed_log(spark: SparkSession, d: str) -> DataFrame:
    return logs.parse_raw_log(tables.raw_log_lines(spark, d))


def live_summary(spark: SparkSession, d: str, hours: DataFrame, grain: Grain) -> DataFrame:
    return flows.period_summary(hours, grain, *live_days(spark, d), trimmed=True)


def demand_requests(spark: SparkSession, d: str, grain: Grain) -> DataFrame:
    return kpi.counted_requests(tables.demand_viewing(spark, d), grain)


def demand_summary(spark: SparkSession, d: str, requests: DataFrame, grain: Grain) -> DataFrame:
    return flows.period_summary(
        requests, grain, *demand_days(spark, d), seed_cover=tables.base_users(spark, d),
        look_back=True, demand=True, own_key=True, trimmed=True, counted=True,
    )


def demand_hour_summary(spark: SparkSession, d: str, grain: Grain) -> DataFrame:
    requests = kpi.counted_requests(tables.demand_hours(spark, d), grain)
    return flows.period_summary(
        requests, grain, *live_days(spark, d), demand=True,
        own_key=True, trimmed=True, counted=True,
    )


# Scans.

def parse_raw_log(spark, d):
    return parsed_log(spark, d).drop("fields")


def scan_live(spark, d):
    return records.parse_records(tsv_lines(live_hours(spark, d)), records.LIVE_VIEWING)


def scan_demand(spark, d):
    rows = tables.demand_hours(spark, d)
    lines = tsv_lines(rows.select(*[name for name, _ in records.DEMAND_VIEWING]))
    return records.parse_records(lines, records.DEMAND_VIEWING)


def scan_summary_grain(spark, d):
    summary = flows.tagged(live_summary(spark, d, live_hours(spark, d), WEEK), WEEK)
    lines = tsv_lines(summary, decimals=6)
    return records.summary_of(records.parse_records(lines, records.LIVE_SUMMARY), "week")


# Filters and keys.

def filter_live(spark, d):
    return clean.filter_live(parsed_log(spark, d), log_months(spark, d))


def filter_power_events(spark, d):
    return clean.filter_power(parsed_log(spark, d), log_months(spark, d))


def monthly_users_filtered(spark, d):
    return clean.monthly_users(parsed_log(spark, d), log_months(spark, d))


def filter_period_range(spark, d):
    return between_keys(tables.demand_viewing(spark, d), "month", 199511, 199702)


def clean_names(spark, d):
    return tables.raw_names(spark, d).select(
        "event_id",
        clean_channel(F.col("channel_raw")).alias("channel_name"),
        known_or_mark(F.col("program_raw")).alias("program_name"),
    )


def calendar_keys(spark, d):
    ordered = tables.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts")
    )
    logged = tables.table(spark, d, "events").select(F.col("event_id").alias("id"), "ts")
    return with_calendar_keys(ordered.unionByName(logged)).drop("ts")


def route_events(spark, d):
    return clean.route_events(logs.parse_raw_log(tables.routed_log_lines(spark, d)))


def route_events_sorted(spark, d):
    return layout.sorted_for_files(route_events(spark, d), ["key_1", "key_2"])


# Viewing.

def shutdown_times(spark, d):
    return viewing.shutdown_times(tables.power_log(spark, d), TIE)


def dwell_time(spark, d):
    off = viewing.shutdown_times(tables.power_log(spark, d), TIE)
    return viewing.dwell_times(tables.live_log(spark, d), off, TIE).drop("slot")


def _middle(spark: SparkSession, d: str) -> Column:
    """Midnight in the middle of the days of the events."""
    first, last = live_days(spark, d)
    return F.date_add(first, F.floor(F.date_diff(last, first) / 2).cast("int")).cast("timestamp_ntz")


def dwell_time_batches(spark, d):
    """The log measured in two batches, the second with what the first could not settle. Each batch's
    lines and state are tables, as between runs of the job."""
    cut = F.col("ts") < _middle(spark, d)
    state, parts = None, []
    for batch in (cut, ~cut):
        live, power = (rows.filter(batch) for rows in (tables.live_log(spark, d), tables.power_log(spark, d)))
        marked = saved(timelines.lines(live, power, state, TIE))
        state = timelines.State(
            saved(timelines.carried(marked)), saved(timelines.last_power(power, state, TIE))
        )
        parts.append(timelines.settled(marked))
    return reduce(DataFrame.unionByName, [*parts, timelines.rest(state)]).drop("slot")


# Flows.

def live_prepare(grain: Grain, spark, d):
    return flows.tagged(live_summary(spark, d, live_hours(spark, d), grain), grain)


def demand_prepare(grain: Grain, spark, d):
    return flows.tagged(demand_summary(spark, d, demand_requests(spark, d, grain), grain), grain)


def live_prepare_seeded(spark, d, grain: Grain = DAY):
    base = tables.base_users(spark, d)
    return flows.tagged(
        flows.period_summary(
            live_hours(spark, d), grain, *live_days(spark, d), trimmed=True,
            seed_cover=base, seed_previous=extracts.least_users(base, 20),
        ),
        grain,
    )


def demand_prepare_look_back(spark, d):
    return flows.tagged(
        flows.period_summary(
            demand_requests(spark, d, MONTH), MONTH, "1995-12-01", demand_days(spark, d)[1],
            seed_cover=tables.base_users(spark, d), look_back=True, demand=True,
            own_key=True, counted=True,
        ),
        MONTH,
    )


def cover_users_day(spark, d):
    return live_summary(spark, d, live_hours(spark, d), DAY).select("day", "cover_user_num")


def cover_users_day_batches(spark, d):
    """Users reached, from first days that a second batch extends by the users it finds new."""
    days = saved(live_hours(spark, d).select("uid", "day").distinct())
    cut = F.col("day") < _middle(spark, d).cast("date")
    known = saved(reached.first_days(days.filter(cut)))
    seen = known.unionByName(reached.new_users(days.filter(~cut), known))
    return reached.cover(seen, DAY, *live_days(spark, d))


def users_by_period(spark, d):
    return flows.users_by(live_hours(spark, d), ["day"])


def shows_by_period(spark, d):
    return flows.shows_by(tables.demand_viewing(spark, d), ["month"])


def moved_in_day(spark, d, entering: bool = True):
    name = "user_in_num" if entering else "user_out_num"
    moved = flows.moved_users(live_hours(spark, d), DAY, entering=entering)
    return (
        moved.filter(F.col("day") <= live_days(spark, d)[1])
        .groupBy("day")
        .agg(F.count("*").alias(name))
    )


# Live reports.

def live_summary_report(grain: Grain, spark, d):
    hours = live_hours(spark, d)
    if grain is HOUR:
        return levels.hour_summary(levels.live_pieces(hours), *live_days(spark, d), kpi.LIVE)
    return kpi.summary_report(live_summary(spark, d, hours, grain), grain, kpi.LIVE)


def live_group_report(report, grain: Grain, spark, d, **options):
    hours = live_hours(spark, d)
    dictionary = tables.channel_dictionary(spark)
    if grain is HOUR:
        one_pass = levels.hour_type_report if report is kpi.type_report else levels.hour_item_report
        return one_pass(levels.live_pieces(hours), dictionary, *live_days(spark, d), kpi.LIVE, **options)
    rows = kpi.per_user(hours, grain, ["channel_name"])
    totals = flows.period_summary(rows, grain, *live_days(spark, d), own_key=True, trimmed=True)
    return report(rows, dictionary, totals, grain, kpi.LIVE, **options)


def live_show_hour(spark, d):
    report = live_group_report(kpi.item_report, HOUR, spark, d, programs=True)
    return kpi.ranked(report, ["day", "hour", "channel_name", "show_name"])


def enrich_type(spark, d):
    return kpi.with_type(live_hours(spark, d), tables.channel_dictionary(spark))


# Demand reports.

def demand_summary_report(grain: Grain, spark, d):
    if grain is HOUR:
        seen = kpi.distinct_requests(tables.demand_hours(spark, d), HOUR)
        return levels.hour_summary(levels.request_piece(seen), *live_days(spark, d), kpi.DEMAND)
    summary = demand_summary(spark, d, demand_requests(spark, d, grain), grain)
    return kpi.summary_report(summary, grain, kpi.DEMAND)


def demand_group_report(report, grain: Grain, spark, d):
    if grain is HOUR:
        seen = kpi.distinct_requests(tables.demand_hours(spark, d), HOUR)
        one_pass = levels.hour_type_report if report is kpi.type_report else levels.hour_item_report
        return one_pass(levels.request_piece(seen), tables.hour_show_dictionary(spark), *live_days(spark, d), kpi.DEMAND)
    one_pass = levels.type_report if report is kpi.type_report else levels.item_report
    return one_pass(
        demand_requests(spark, d, grain), tables.show_dictionary(spark, d), grain, *demand_days(spark, d),
        kpi.DEMAND, kinds=tables.PART_TYPES, seed_cover=tables.base_users(spark, d),
    )


def dedupe_demand(spark, d):
    return kpi.distinct_requests(tables.demand_viewing(spark, d), MONTH)


def request_times_hour(spark, d):
    rows = kpi.distinct_requests(tables.demand_hours(spark, d), HOUR)
    return kpi.request_times(rows, ["day", "hour"])


def fix_week(make, spark, d):
    return shift_week(make(WEEK, spark, d), -1)


# Overview. The demand source numbers its weeks one too high; so does this table.

def overview_of(grain: Grain, spark, d):
    if grain is HOUR:
        return overview.hour_overview_report(
            live_summary_report(HOUR, spark, d), demand_summary_report(HOUR, spark, d)
        )
    demand = demand_hour_summary(spark, d, grain)
    if grain is WEEK:
        demand = shift_week(demand, 1)
    return overview.overview_report(
        live_summary(spark, d, live_hours(spark, d), grain), demand, grain
    )


# Extractions and layout.

def extract_uids(spark, d):
    return extracts.first_users(live_hours(spark, d), (202401, 202402), 100)


def distinct_channels(spark, d):
    return extracts.distinct_channels(live_hours(spark, d), 202312, 202402)


def dictionary_sorted(spark, d):
    return extracts.sorted_dictionary(tables.show_dictionary(spark, d))


def all_time_channel(spark, d):
    log = records.parse_prototype(tables.prototype_lines(spark, d))
    return extracts.channel_by_frame(log, tables.channel_dictionary(spark))


def partition_by_viewer(spark, d):
    placed = layout.partition_by_viewer(
        tables.live_log(spark, d), 16, sort=("uid", "ts", "event_id"), spread=2
    )
    # Two partitions to a slot: the slot a row really lies in is its partition over two.
    slot = F.floor(F.spark_partition_id() / 2).cast("int").alias("slot")
    return placed.select(slot, "uid").groupBy("slot").agg(
        F.count("*").alias("n_rows"), F.count_distinct("uid").alias("user_num")
    )


def _text_dates(query: Query, spark: SparkSession, d: str) -> DataFrame:
    """Dates and times as ISO text, the form in which the reports show them."""
    df = query(spark, d)
    timed = [f.name for f in df.schema.fields
             if f.dataType.typeName() in ("date", "timestamp", "timestamp_ntz")]
    return df.withColumns({name: F.col(name).cast("string") for name in timed}) if timed else df


def _registry() -> dict[str, Query]:
    named: dict[str, Query] = {
        "parse_raw_log": parse_raw_log,
        "scan_live": scan_live,
        "scan_demand": scan_demand,
        "scan_summary_grain": scan_summary_grain,
        "filter_live": filter_live,
        "filter_power_events": filter_power_events,
        "monthly_users_filtered": monthly_users_filtered,
        "filter_period_range": filter_period_range,
        "clean_channel": clean_names,
        "calendar_keys": calendar_keys,
        "route_events": route_events,
        "route_events_sorted": route_events_sorted,
        "shutdown_times": shutdown_times,
        "dwell_time": dwell_time,
        "dwell_time_batches": dwell_time_batches,
        "dwell_hourly": live_hours,
        "split_dwell_hours": live_pieces,
        "live_prepare_seeded": live_prepare_seeded,
        "demand_prepare_look_back": demand_prepare_look_back,
        "cover_users_day": cover_users_day,
        "cover_users_day_batches": cover_users_day_batches,
        "users_by_period": users_by_period,
        "shows_by_period": shows_by_period,
        "user_in_day": moved_in_day,
        "user_out_day": partial(moved_in_day, entering=False),
        "live_show_hour": live_show_hour,
        "enrich_type": enrich_type,
        "dedupe_demand": dedupe_demand,
        "request_times_hour": request_times_hour,
        "fix_week": partial(fix_week, demand_summary_report),
        "fix_week_type": partial(fix_week, partial(demand_group_report, kpi.type_report)),
        "fix_week_show": partial(fix_week, partial(demand_group_report, kpi.item_report)),
        "extract_uids": extract_uids,
        "distinct_channels": distinct_channels,
        "dictionary_sorted": dictionary_sorted,
        "all_time_channel": all_time_channel,
        "partition_by_viewer": partition_by_viewer,
    }
    for name, grain in GRAINS.items():
        named[f"live_summary_{name}"] = partial(live_summary_report, grain)
        named[f"live_type_{name}"] = partial(live_group_report, kpi.type_report, grain)
        named[f"live_channel_{name}"] = partial(live_group_report, kpi.item_report, grain)
        named[f"demand_summary_{name}"] = partial(demand_summary_report, grain)
        named[f"demand_type_{name}"] = partial(demand_group_report, kpi.type_report, grain)
        named[f"demand_show_{name}"] = partial(demand_group_report, kpi.item_report, grain)
        named[f"overview_{name}"] = partial(overview_of, grain)
        if grain is not HOUR:
            named[f"live_prepare_{name}"] = partial(live_prepare, grain)
            named[f"demand_prepare_{name}"] = partial(demand_prepare, grain)
    return {name: partial(_text_dates, query) for name, query in named.items()}


QUERIES = _registry()
