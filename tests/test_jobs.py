"""The chain of jobs from raw log files to reports, on the log lines of the small tables."""

import glob
import gzip
import os
import shutil
import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from airwave.functions.calendar import DAY, MONTH, WEEK, shift_week
from airwave.functions.text import tsv_lines
from airwave.operators import clean, flows, kpi, viewing
from airwave.plans import jobs, queries
from airwave.sinks import exchange
from airwave.sources import logs, records, tables

DAYS = {"first": "2024-01-01", "last": "2024-01-30"}
MONTHS = {"first_month": 202401, "last_month": 202401}


def lines(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def text_of(df, decimals=4):
    return sorted(r.value for r in tsv_lines(df, decimals).collect())


@pytest.fixture(scope="module")
def home(spark, sf_dir):
    """A folder in which the jobs have run."""
    at = tempfile.mkdtemp(prefix="run-") + "/"
    tables.raw_log_lines(spark, sf_dir).repartition(3).write.option(
        "compression", "gzip").text(at + "raw")
    tsv_lines(tables.channel_dictionary(spark)).write.text(at + "channels")
    jobs.filter_live(spark, at + "raw", at + "live", files=6, **MONTHS)
    jobs.find_shutdowns(spark, at + "raw", at + "off", files=2, **MONTHS)
    jobs.measure_viewing(spark, at + "live", at + "off", at + "hours", files=3)
    jobs.split_viewing(spark, at + "hours", at + "pieces", files=3)
    jobs.seed_users(spark, at + "pieces", at + "seeds", n=5, month=202401)
    jobs.summarize_live(spark, at + "hours", at + "seeds", at + "live_sum", **DAYS)

    rows = shift_week(tables.demand_hours(spark, sf_dir), 1)
    rows = rows.select(*[name for name, _ in records.DEMAND_VIEWING])
    tsv_lines(rows).write.text(at + "demand")
    tsv_lines(tables.hour_show_dictionary(spark)).write.text(at + "shows")
    jobs.summarize_demand(spark, at + "demand", at + "seeds", at + "demand_sum", **DAYS)
    return at


@pytest.fixture(scope="module")
def hours(spark, sf_dir):
    log = queries.parsed_log(spark, sf_dir)
    live = clean.filter_live(log, (202401, 202401))
    off = viewing.shutdown_times(clean.filter_power(log, (202401, 202401)))
    return viewing.hourly_viewing(viewing.dwell_times(live, off)).cache()


def stored(spark, path):
    return text_of(exchange.read_rows(spark, path, records.LIVE_VIEWING))


def test_viewing_files(spark, home, hours):
    assert stored(spark, home + "hours") == text_of(hours.select(*[n for n, _ in records.LIVE_VIEWING]))
    assert stored(spark, home + "pieces") == text_of(viewing.split_hours(hours))


def test_viewing_of_a_stored_stream(spark, home):
    jobs.store_stream(spark, home + "live", home + "off", home + "stream", buckets=8)
    jobs.measure_stored(spark, home + "stream", home + "stored_hours")
    assert stored(spark, home + "stored_hours") == stored(spark, home + "hours")


def test_viewing_of_two_batches(spark, home, hours):
    raw = spark.read.text(home + "raw")
    time = F.regexp_extract("value", r"(20240[12]\d{8})", 1)
    for name, part in (("a", time < "20240111093000"), ("b", time >= "20240111093000")):
        raw.filter(part).write.text(f"{home}raw_{name}")
    jobs.extend_viewing(spark, home + "raw_a", home + "ext_a", home + "state_a", **MONTHS)
    jobs.extend_viewing(spark, home + "raw_b", home + "ext_b", home + "state_b", before=home + "state_a", **MONTHS)
    jobs.finish_viewing(spark, home + "state_b", home + "ext_c")
    parts = [exchange.read_rows(spark, f"{home}ext_{n}", records.LIVE_VIEWING) for n in "abc"]
    keys = [n for n, _ in records.LIVE_VIEWING if n != "seconds"]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy(*keys).agg(F.sum("seconds").alias("seconds"))
    assert text_of(both.select(*[n for n, _ in records.LIVE_VIEWING])) == stored(spark, home + "hours")
    assert min(part.count() for part in parts[:2]) > 0


def test_summaries_of_two_batches(spark, home):
    args = (home + "hours", home + "seeds", home + "reached")
    jobs.extend_live(spark, *args, home + "sum_a", "2024-01-01", "2024-01-16", buckets=8)
    jobs.extend_live(spark, *args, home + "sum_b", "2024-01-17", "2024-01-30", buckets=8)
    got = {}
    for name in ("sum_a", "sum_b"):
        got |= {tuple(v.split("\t")[:2]): v for v in lines(spark, home + name)}
    assert sorted(got.values()) == lines(spark, home + "live_sum")


def test_the_chain_as_text_gives_the_same(spark, home):
    as_text = {"form": "text"}
    jobs.filter_live(spark, home + "raw", home + "t_live", files=2, **MONTHS, **as_text)
    jobs.find_shutdowns(spark, home + "raw", home + "t_off", **MONTHS, **as_text)
    jobs.measure_viewing(spark, home + "t_live", home + "t_off", home + "t_hours", files=3, **as_text)
    assert lines(spark, home + "t_hours") == stored(spark, home + "hours")
    for form, source in (("text", "t_hours"), ("parquet", "hours")):
        jobs.report_live(spark, home + source, home + "channels", home + "live_sum", f"{home}by_{form}", "week",
                         "202402", "202403", form=form)
    for name in ("summary", "channelType", "channel"):
        assert lines(spark, f"{home}by_text/{name}") == lines(spark, f"{home}by_parquet/{name}")


def test_a_report_opens_the_days_of_its_period_alone(spark, home):
    days = sorted(os.path.basename(d) for d in glob.glob(home + "hours/day=*"))
    assert len(days) > 20
    shutil.copytree(home + "hours", home + "broken")
    inside = {f"day=2024-01-{d:02}" for d in range(8, 15)}
    for file in glob.glob(home + "broken/day=*/*.parquet"):
        if os.path.basename(os.path.dirname(file)) not in inside:
            with open(file, "wb") as broken:
                broken.write(b"not parquet")
    for crc in glob.glob(home + "broken/day=*/.*.crc"):
        os.remove(crc)
    names = (home + "channels", home + "live_sum")
    jobs.report_live(spark, home + "broken", *names, home + "week_2", "week", "202402", "202402")
    jobs.report_live(spark, home + "hours", *names, home + "week_2_whole", "week", "202402", "202402")
    for name in ("channelType", "channel"):
        assert lines(spark, f"{home}week_2/{name}") == lines(spark, f"{home}week_2_whole/{name}")
        assert lines(spark, f"{home}week_2/{name}")


def test_days_of_a_period_range():
    assert jobs._days_of(WEEK, 202053, 202101) == (date(2020, 12, 28), date(2021, 1, 10))
    assert jobs._days_of(MONTH, 202311, 202312) == (date(2023, 11, 1), date(2023, 12, 31))
    assert jobs._days_of(MONTH, "202402", "202402") == (date(2024, 2, 1), date(2024, 2, 29))


def test_lines_of_a_gzip_file_are_spread(spark, home, monkeypatch):
    spark.read.text(home + "raw").coalesce(1).write.option("compression", "gzip").text(home + "one_gz")
    (path,) = glob.glob(home + "one_gz/*.gz")
    assert logs.read_lines(spark, path).rdd.getNumPartitions() == 1 and logs.gzip_parts(spark, path) is None
    monkeypatch.setattr(logs, "GZIP_BYTES", os.path.getsize(path) // 4)
    for at in (path, home + "one_gz"):
        assert logs.read_lines(spark, at).rdd.getNumPartitions() in (4, 5)
    assert jobs._log(spark, path).rdd.getNumPartitions() in (4, 5)
    assert logs.gzip_parts(spark, home + "channels", 1) is None


def test_seed_file(spark, home, hours):
    expected = sorted({int(r.uid) for r in hours.select("uid").collect()})[:5]
    assert sorted(map(int, lines(spark, home + "seeds"))) == expected


def test_live_summary_file(spark, home, hours):
    got = [line.split("\t") for line in lines(spark, home + "live_sum")]
    assert [row[0] for row in got].count("day") == 30
    seeds = spark.read.text(home + "seeds").withColumnRenamed("value", "uid")
    expected = flows.period_summary(
        hours, DAY, *DAYS.values(), seed_cover=seeds, seed_previous=seeds)
    assert ["\t".join(r) for r in got if r[0] == "day"] == text_of(flows.tagged(expected, DAY), 6)


@pytest.mark.parametrize("grain,low,high", [
    ("hour", "2024-01-01", "2024-01-31"), ("day", "2024-01-01", "2024-01-31"),
    ("week", "202401", "202405"), ("month", "202401", "202401")])
def test_live_reports(spark, home, grain, low, high):
    source = home + ("pieces" if grain == "hour" else "hours")
    out = f"{home}live_{grain}"
    jobs.report_live(spark, source, home + "channels", home + "live_sum", out, grain, low, high)
    keys = 2 if grain == "hour" else 1
    widths = {"summary": keys + (8 if grain == "hour" else 11), "channelType": keys + 9,
              "channel": keys + 10}
    for name, width in widths.items():
        rows = lines(spark, f"{out}/{name}")
        assert rows and all(len(r.split("\t")) == width for r in rows)


def test_range_limits_the_detail_only(spark, home):
    out = home + "one_day"
    jobs.report_live(spark, home + "hours", home + "channels", home + "live_sum", out, "day",
                     "2024-01-05", "2024-01-05")
    assert {r.split("\t")[0] for r in lines(spark, out + "/channel")} == {"2024-01-05"}
    assert len(lines(spark, out + "/summary")) == 30


def test_program_report_is_ranked(spark, home):
    out = home + "programs"
    jobs.report_programs(spark, home + "pieces", home + "channels", home + "live_sum", out,
                         "2024-01-01", "2024-01-31")
    parts = sorted(glob.glob(out + "/show/part-*"))
    index = [line.split("\t")[5] for part in parts for line in gzip.open(part, "rt")]
    index = [float("-inf" if i == "null" else i) for i in index]
    assert index and index == sorted(index, reverse=True)


def test_demand_weeks_and_their_fix(spark, home, sf_dir):
    out = home + "demand_week"
    jobs.report_demand(spark, home + "demand", home + "shows", home + "demand_sum", out, "week",
                       "202402", "202406")
    jobs.fix_weeks(spark, out + "/summary", out + "/showType", out + "/show", home + "fixed")
    rows = kpi.distinct_requests(tables.demand_hours(spark, sf_dir), WEEK)
    seeds = spark.read.text(home + "seeds").select(F.col("value").cast("long").alias("uid"))
    summary = flows.period_summary(tables.demand_hours(spark, sf_dir), WEEK, *DAYS.values(),
                                   seed_cover=seeds, look_back=True, demand=True)
    names = tables.hour_show_dictionary(spark)
    expected = kpi.type_report(rows, names, summary, WEEK, kpi.DEMAND)
    assert lines(spark, home + "fixed/showType") == text_of(expected)
    assert lines(spark, home + "fixed/summary") == text_of(
        kpi.summary_report(summary, WEEK, kpi.DEMAND))


def test_demand_hours_and_overviews(spark, home):
    for business, job, source, names in (
        ("live", jobs.report_live, "pieces", "channels"),
        ("demand", jobs.report_demand, "demand", "shows"),
    ):
        job(spark, home + source, home + names, f"{home}{business}_sum", f"{home}{business}_t",
            "hour", "2024-01-01", "2024-01-31")
    jobs.report_overview_hours(
        spark, home + "live_t/summary", home + "demand_t/summary", home + "both_t")
    both = lines(spark, home + "both_t")
    assert both and all(len(r.split("\t")) == 10 for r in both)
    for grain, count in (("day", 30), ("week", 5), ("month", 1)):
        jobs.report_overview(
            spark, home + "live_sum", home + "demand_sum", f"{home}both_{grain}", grain)
        rows = lines(spark, f"{home}both_{grain}")
        assert len(rows) == count and all(len(r.split("\t")) == 12 for r in rows)


def test_small_jobs(spark, home, sf_dir):
    tables.routed_log_lines(spark, sf_dir).write.text(home + "mixed")
    tables.prototype_lines(spark, sf_dir).write.text(home + "proto")
    jobs.route_log(spark, home + "mixed", home + "routed", files=3)
    keys = [tuple(r.value.split("\t")[:2]) for r in
            spark.read.text(home + "routed").collect()]
    assert len(keys) == clean.route_events(
        logs.parse_raw_log(tables.routed_log_lines(spark, sf_dir))).count()
    jobs.count_users(spark, home + "raw", home + "users", **MONTHS)
    assert lines(spark, home + "users")[0].startswith("202401\t")
    jobs.list_channels(spark, home + "hours", home + "names", after=202312, before=202402)
    assert "?" in lines(spark, home + "names")
    jobs.sort_dictionary(spark, home + "channels", home + "sorted")
    assert len(lines(spark, home + "sorted")) == 15
    jobs.report_frames(spark, home + "proto", home + "channels", home + "frames")
    assert len(lines(spark, home + "frames")[0].split("\t")) == 9


def test_reports_are_loaded_into_tables(spark, home):
    """A report run again over its last days replaces these and leaves the earlier ones."""
    at = home + "tables"
    names = (home + "channels", home + "live_sum")
    runs = ((1, "2024-01-01", "2023-12-31"), (2, "2024-01-10", "2024-01-09"))
    for n, low, after in runs:
        jobs.report_live(spark, home + "hours", *names, f"{home}load_{n}", "day", low, "2024-01-31",
                         load=at, after=after)
    jobs.report_overview(spark, home + "live_sum", home + "demand_sum", home + "load_both", "day",
                         load=at, after="2023-12-31")
    for name in ("summary", "channelType", "channel"):
        table = spark.read.parquet(f"{at}/{name}_day")
        first = lines(spark, f"{home}load_1/{name}")
        live = table.filter("user_type = 1 AND grain = 'day'")
        assert live.count() == len(first) > 0
        days = sorted(str(r.day) for r in live.collect())
        assert days == sorted(line.split("\t")[0] for line in first)
    kinds = {r.user_type for r in spark.read.parquet(f"{at}/summary_day").select("user_type").distinct().collect()}
    assert len(kinds) == 2
    assert not glob.glob(f"{at}/*.staging/*")
    with pytest.raises(ValueError, match="after"):
        jobs.report_live(spark, home + "hours", *names, home + "load_3", "day", "2024-01-01", "2024-01-31", load=at)


def test_job_list():
    assert {"filter_live", "summarize_demand", "report_live", "route_log"} <= set(jobs.JOBS)
    assert not any(name.startswith("_") for name in jobs.JOBS)
