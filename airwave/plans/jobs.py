"""File-to-file jobs: the whole chain from raw logs to report tables.

Run one with ``python -m airwave.plans.jobs NAME key=value ...``; each function below is a
job and its arguments are the keys. Jobs hand each other Parquet, viewing records by day, so that a
report opens the days of its period alone; with ``form=text`` they write and read gzip text, one
file per task, or ``files`` of them. Reports are one text file each, but those with a row per channel
or show are as many as they have partitions. With ``load=FOLDER`` a report goes into its table there
as well, ``FOLDER/NAME_GRAIN``: rows of its user type with a key above ``after`` are replaced. It is
computed once for both.
"""

from __future__ import annotations

import inspect
import sys
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave import session
from airwave.functions.calendar import (
    DAY,
    GRAINS,
    HOUR,
    MONTH,
    WEEK,
    between_keys,
    shift_week,
)
from airwave.functions.text import log_time
from airwave.operators import clean, extracts, flows, kpi, layout, overview, timelines
from airwave.operators import viewing as views
from airwave.sinks import history, tables, viewers
from airwave.sinks.exchange import EVENTS, PARQUET, TEXT, read_rows, write_events, write_rows
from airwave.sinks.text import write_report, write_sorted_summary, write_tsv
from airwave.sources import logs, records

# The calendar the jobs cover by default, and how many seed users count as
# active before its first day, week and month (None: all).
FIRST_DAY, LAST_DAY = "2016-04-01", "2016-09-30"
SEEDS_BEFORE = {"day": 120_000, "week": 170_000, "month": None}
# Fixed value: demand records number their weeks one too high.
DEMAND_WEEKS_AHEAD = 1
#: What goes along from one batch of a log to the next.
OPEN_STATE = {
    "live": "uid string, ts timestamp_ntz, channel_name string, program_name string, until timestamp_ntz",
    "power": "uid string, ts timestamp_ntz, opens boolean",
}
#: Reports whose rows grow with the channels or shows and not with the calendar alone.
ITEM_REPORTS = ("channel", "show")


def _log(spark: SparkSession, raw: str) -> DataFrame:
    return logs.parse_raw_log(logs.read_lines(spark, raw))


def _months(first: int, last: int) -> tuple[int, int]:
    return int(first), int(last)


# Raw logs to viewing records.

def filter_live(spark, raw: str, out: str, files: int = 0, spread: int = 1,
                first_month: int = clean.FIRST_MONTH, last_month: int = clean.LAST_MONTH,
                form: str = PARQUET) -> None:
    """With ``files``, viewers are placed by their last digits, each over ``spread`` files."""
    rows = clean.filter_live(_log(spark, raw), _months(first_month, last_month))
    if files:
        rows = layout.partition_by_viewer(rows, files, spread=spread)
    write_events(rows, out, form=form)


def find_shutdowns(spark, raw: str, out: str, files: int = 0,
                   first_month: int = clean.FIRST_MONTH, last_month: int = clean.LAST_MONTH,
                   form: str = PARQUET) -> None:
    rows = clean.filter_power(_log(spark, raw), _months(first_month, last_month))
    write_events(views.shutdown_times(rows), out, form=form, files=files)


def _stream(spark: SparkSession, path: str, form: str) -> DataFrame:
    if form != TEXT:
        return read_rows(spark, path, EVENTS, form)
    rows = records.read_records(spark, path, records.STREAM)
    timed = rows.withColumn("ts", log_time(F.col("time_text"))).filter(F.col("ts").isNotNull())
    return timed.select("uid", "ts", "channel_name", "program_name")


def measure_viewing(spark, live: str, shutdowns: str, out: str, files: int = 0, form: str = PARQUET) -> None:
    dwell = views.dwell_times(_stream(spark, live, form), _stream(spark, shutdowns, form))
    write_rows(views.hourly_viewing(dwell), out, records.LIVE_VIEWING, form=form, files=files)


def store_stream(spark, live: str, shutdowns: str, out: str, buckets: int = viewers.BUCKETS, form: str = PARQUET) -> None:
    """Live and shutdown records by user, for ``measure_stored``."""
    viewers.write_stream(_stream(spark, live, form), _stream(spark, shutdowns, form), out, buckets)


def measure_stored(spark, stream: str, out: str, files: int = 0, form: str = PARQUET) -> None:
    """``measure_viewing`` of a stored stream; its rows are not shuffled."""
    dwell = views.dwell_of_stored(viewers.read_stream(spark, stream))
    write_rows(views.hourly_viewing(dwell), out, records.LIVE_VIEWING, form=form, files=files)


def extend_viewing(spark, raw: str, out: str, state: str, before: str = "",
                   first_month: int = clean.FIRST_MONTH, last_month: int = clean.LAST_MONTH,
                   form: str = PARQUET, files: int = 0) -> None:
    """Viewing of one batch of a log. What it cannot settle goes to ``state``; ``before`` is the state of
    the batch before. A batch can be run again, as it changes nothing of ``before``."""
    log, months = _log(spark, raw), _months(first_month, last_month)
    live, power = clean.filter_live(log, months), clean.filter_power(log, months)
    old = None
    if before:
        old = timelines.State(
            *[spark.read.schema(layout).parquet(f"{before}/{name}") for name, layout in OPEN_STATE.items()]
        )
    with tables.staged(timelines.lines(live, power, old), out) as marked:
        timelines.carried(marked).write.parquet(f"{state}/live")
        timelines.last_power(power, old).write.parquet(f"{state}/power")
        hours = views.hourly_viewing(timelines.settled(marked))
        write_rows(hours, out, records.LIVE_VIEWING, form=form, files=files)


def finish_viewing(spark, state: str, out: str, form: str = PARQUET, files: int = 0) -> None:
    """Viewing that is left in the state after the last batch."""
    left = timelines.State(
        *[spark.read.schema(layout).parquet(f"{state}/{name}") for name, layout in OPEN_STATE.items()]
    )
    write_rows(views.hourly_viewing(timelines.rest(left)), out, records.LIVE_VIEWING, form=form, files=files)


def _viewing(spark: SparkSession, path: str, form: str) -> DataFrame:
    return read_rows(spark, path, records.LIVE_VIEWING, form)


def split_viewing(spark, viewing: str, out: str, files: int = 0, form: str = PARQUET) -> None:
    pieces = views.split_hours(_viewing(spark, viewing, form))
    write_rows(pieces, out, records.LIVE_VIEWING, form=form, files=files)


def seed_users(spark, viewing: str, out: str, n: int = extracts.SEED_USERS,
               month: int = 201604, other_month: int = 201605, form: str = PARQUET) -> None:
    rows = _viewing(spark, viewing, form)
    days = [F.col("day").between(*_days_of(MONTH, m, m)) for m in (month, other_month)]
    write_tsv(extracts.first_users(rows.filter(days[0] | days[1]), (month, other_month), n), out, files=1)


# Period summaries.

def summarize_live(spark, viewing: str, users: str, out: str,
                   first: str = FIRST_DAY, last: str = LAST_DAY, form: str = PARQUET) -> None:
    rows = _viewing(spark, viewing, form)
    base = records.read_records(spark, users, records.UIDS)
    parts = []
    for grain in (DAY, WEEK, MONTH):
        n = SEEDS_BEFORE[grain.name]
        before = base if n is None else extracts.least_users(base, n)
        summary = flows.period_summary(
            rows, grain, first, last, seed_cover=base, seed_previous=before
        )
        parts.append(flows.tagged(summary, grain))
    write_sorted_summary(reduce(DataFrame.unionByName, parts), out)


def extend_live(spark, viewing: str, users: str, state: str, out: str, first: str, last: str,
                buckets: int = viewers.BUCKETS, form: str = PARQUET) -> None:
    """``summarize_live`` of the periods that the days from ``first`` to ``last`` touch.

    Reads those days and, from ``state``, the period before and the users reached. Of the seed users,
    those active before the calendar count in a grain's first period alone, whichever run gives it.
    """
    base = records.read_records(spark, users, records.UIDS)
    if history.user_days(spark, state).isEmpty():
        history.begin(base, state, buckets)
    rows = between_keys(_viewing(spark, viewing, form), "day", date.fromisoformat(first), date.fromisoformat(last))
    history.extend(rows, state, first, last, buckets)
    parts = []
    for grain in (DAY, WEEK, MONTH):
        before = None
        if history.is_first_period(spark, state, grain, first):
            n = SEEDS_BEFORE[grain.name]
            before = base if n is None else extracts.least_users(base, n)
        parts.append(flows.tagged(history.summary(spark, state, grain, first, last, before), grain))
    write_sorted_summary(reduce(DataFrame.unionByName, parts), out)


def _demand(spark: SparkSession, path: str) -> DataFrame:
    """Demand records with week keys that exist, as a 53rd week may be the next year's 1st."""
    return shift_week(records.read_records(spark, path, records.DEMAND_VIEWING), 0)


def summarize_demand(spark, viewing: str, users: str, out: str,
                     first: str = FIRST_DAY, last: str = LAST_DAY) -> None:
    rows = _demand(spark, viewing)
    base = records.read_records(spark, users, records.UIDS)
    parts = []
    for grain in (DAY, WEEK, MONTH):
        ahead = 7 * DEMAND_WEEKS_AHEAD if grain is WEEK else 0
        days = [F.date_add(F.lit(day).cast("date"), ahead) for day in (first, last)]
        summary = flows.period_summary(
            rows, grain, *days, seed_cover=base, look_back=True, demand=True, own_key=True
        )
        parts.append(flows.tagged(summary, grain))
    write_sorted_summary(reduce(DataFrame.unionByName, parts), out)


# Reports.

def _days_of(grain, low: int, high: int) -> tuple[date, date]:
    """First and last day of a range of week or month keys."""
    low, high = int(low), int(high)
    if grain is WEEK:
        return date.fromisocalendar(low // 100, low % 100, 1), date.fromisocalendar(high // 100, high % 100, 7)
    after = date(high // 100 + high % 100 // 12, high % 100 % 12 + 1, 1)
    return date(low // 100, low % 100, 1), after - timedelta(days=1)


def live_in_range(rows: DataFrame, grain, low, high) -> DataFrame:
    """Live records of a period range; their weeks and months follow from the day, so the days of the
    range say it too, and other days' directories stay closed."""
    if grain in (WEEK, MONTH):
        rows = between_keys(rows, "day", *_days_of(grain, low, high))
    return _in_range(rows, grain, low, high)


def _in_range(rows: DataFrame, grain, low, high) -> DataFrame:
    if grain in (HOUR, DAY):
        return between_keys(rows, "day", low, high)
    return between_keys(rows, grain.name, int(low), int(high))


def _summary(spark, path: str, business, grain) -> DataFrame:
    table = records.LIVE_SUMMARY if business is kpi.LIVE else records.DEMAND_SUMMARY
    name = "day" if grain is HOUR else grain.name
    return records.summary_of(records.read_records(spark, path, table), name)


def _publish(report: DataFrame, out: str, name: str, load: str, user_type: int, grain, after: str) -> None:
    """Text under ``out`` and, with ``load``, the rows above ``after`` in their table; the report runs once."""
    items = name in ITEM_REPORTS
    if not load:
        write_report(report, out, items=items)
        return
    path, key = f"{load}/{name}_{grain.name}", grain.keys[0]
    bound = F.lit(after).cast("date") if grain in (HOUR, DAY) else F.lit(int(after))
    with tables.staged(report, path) as rows:
        write_report(rows, out, items=items)
        tables.load_staged(rows.filter(F.col(key) > bound), path, user_type, grain.name, bound)


def _check_load(load: str, after: str) -> None:
    if load and not after:
        raise ValueError("load needs after, the last period whose stored rows stay")


def report_live(spark, viewing: str, dictionary: str, summary: str, out: str, grain: str,
                low: str, high: str, weight: float = kpi.WEIGHT, form: str = PARQUET,
                load: str = "", after: str = "") -> None:
    """Summary, channel type and channel; hours take the split records as ``viewing``."""
    _check_load(load, after)
    step = GRAINS[grain]
    rows = live_in_range(_viewing(spark, viewing, form), step, low, high)
    names = records.read_records(spark, dictionary, records.CHANNEL_DICT)
    prepared = _summary(spark, summary, kpi.LIVE, step)
    if step is HOUR:
        overall = kpi.hour_summary_report(rows, prepared, kpi.LIVE)
        totals = kpi.hour_totals(rows, prepared)
    else:
        overall, totals = kpi.summary_report(prepared, step, kpi.LIVE), prepared
    family = {
        "summary": overall,
        "channelType": kpi.type_report(rows, names, totals, step, kpi.LIVE, weight=weight),
        "channel": kpi.item_report(rows, names, totals, step, kpi.LIVE, weight=weight),
    }
    for name, report in family.items():
        _publish(report, f"{out}/{name}", name, load, kpi.LIVE.user_type, step, after)


def report_programs(spark, viewing: str, dictionary: str, summary: str, out: str,
                    low: str, high: str, weight: float = kpi.WEIGHT, form: str = PARQUET) -> None:
    rows = live_in_range(_viewing(spark, viewing, form), HOUR, low, high)
    names = records.read_records(spark, dictionary, records.CHANNEL_DICT)
    totals = kpi.hour_totals(rows, _summary(spark, summary, kpi.LIVE, HOUR))
    report = kpi.item_report(rows, names, totals, HOUR, kpi.LIVE, weight=weight, programs=True)
    # Program rows are many: the sorted parts are files in order, not one file.
    write_tsv(kpi.ranked(report, ["day", "hour", "channel_name", "show_name"]), f"{out}/show", gzip=True)


def report_demand(spark, viewing: str, dictionary: str, summary: str, out: str, grain: str,
                  low: str, high: str, weight: float = kpi.WEIGHT,
                  load: str = "", after: str = "") -> None:
    _check_load(load, after)
    step = GRAINS[grain]
    rows = kpi.distinct_requests(_in_range(_demand(spark, viewing), step, low, high), step)
    names = records.read_records(spark, dictionary, records.SHOW_DICT)
    prepared = _summary(spark, summary, kpi.DEMAND, step)
    if step is HOUR:
        overall = kpi.hour_summary_report(rows, prepared, kpi.DEMAND)
        totals = kpi.hour_totals(rows, prepared, shows="show_name")
    else:
        overall, totals = kpi.summary_report(prepared, step, kpi.DEMAND), prepared
    family = {
        "summary": overall,
        "showType": kpi.type_report(rows, names, totals, step, kpi.DEMAND, weight=weight),
        "show": kpi.item_report(rows, names, totals, step, kpi.DEMAND, weight=weight),
    }
    for name, report in family.items():
        _publish(report, f"{out}/{name}", name, load, kpi.DEMAND.user_type, step, after)


def fix_weeks(spark, summary: str, types: str, shows: str, out: str, by: int = -1) -> None:
    """Move the week, the first column, of the three weekly demand reports."""
    for name, path in (("summary", summary), ("showType", types), ("show", shows)):
        lines = logs.read_lines(spark, path)
        week = F.substring_index("value", "\t", 1)
        rows = lines.select(week.try_cast("int").alias("week"), F.col("value"), week.alias("_week"))
        moved = shift_week(rows.filter(F.col("week").isNotNull()), by)
        rest = F.expr("substring(value, length(_week) + 1)")
        fixed = moved.select(F.concat(F.col("week").cast("string"), rest).alias("value"))
        (fixed if name in ITEM_REPORTS else fixed.repartition(1)).write.text(f"{out}/{name}")


def report_overview(spark, live: str, demand: str, out: str, grain: str,
                    load: str = "", after: str = "") -> None:
    _check_load(load, after)
    step = GRAINS[grain]
    both = (_summary(spark, live, kpi.LIVE, step), _summary(spark, demand, kpi.DEMAND, step))
    report = overview.overview_report(*both, step)
    _publish(report, out, "summary", load, kpi.BOTH, step, after)


def report_overview_hours(spark, live: str, demand: str, out: str) -> None:
    """Takes the hour summary reports of both businesses."""
    both = [records.read_records(spark, path, records.HOUR_SUMMARY) for path in (live, demand)]
    write_tsv(overview.hour_overview_report(*both), out, files=1)


# Extractions.

def route_log(spark, raw: str, out: str, files: int = 0) -> None:
    rows = clean.route_events(_log(spark, raw))
    write_tsv(layout.sorted_for_files(rows, ["key_1", "key_2"], files), out, gzip=True)


def count_users(spark, raw: str, out: str,
                first_month: int = clean.FIRST_MONTH, last_month: int = clean.LAST_MONTH) -> None:
    months = _months(first_month, last_month)
    write_tsv(clean.monthly_users(_log(spark, raw), months), out, files=1)


def list_channels(spark, viewing: str, out: str, after: int = 201603, before: int = 201610,
                  form: str = PARQUET) -> None:
    rows = _viewing(spark, viewing, form)
    write_tsv(extracts.distinct_channels(rows, after, before), out, files=1)


def sort_dictionary(spark, dictionary: str, out: str) -> None:
    names = records.read_records(spark, dictionary, records.CHANNEL_DICT)
    write_tsv(extracts.sorted_dictionary(names), out)


def report_frames(spark, log: str, dictionary: str, out: str) -> None:
    rows = records.parse_prototype(logs.read_lines(spark, log))
    names = records.read_records(spark, dictionary, records.CHANNEL_DICT)
    write_tsv(extracts.channel_by_frame(rows, names), out, files=1)


JOBS = {
    name: job
    for name, job in list(globals().items())
    if inspect.isfunction(job) and job.__module__ == __name__ and not name.startswith("_")
}


def main(arguments: list[str]) -> None:
    name, *pairs = arguments
    job = JOBS[name]
    known = inspect.signature(job).parameters
    values = {}
    for pair in pairs:
        key, _, text = pair.partition("=")
        default = known[key].default
        number = isinstance(default, int | float)
        values[key] = type(default)(text) if number else text
    job(session.build(name), **values)


if __name__ == "__main__":
    main(sys.argv[1:])
