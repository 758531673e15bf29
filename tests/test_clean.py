"""Parsing, validity rules, names, routing, week keys."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from airwave.functions import calendar, text
from airwave.operators import clean, layout
from airwave.sources import logs, records

GOOD = "0201|0999|01;20160401101112;1234567;a;b;c;d;News(pay);null;x;y"


def log(spark, *lines):
    rows = spark.createDataFrame([(line,) for line in lines], "value string")
    return logs.parse_raw_log(rows)


def test_live_record(spark):
    row = clean.filter_live(log(spark, GOOD, GOOD)).collect()
    assert [tuple(r) for r in row] == [
        ("1234567", datetime(2016, 4, 1, 10, 11, 12), "News", "?")]


@pytest.mark.parametrize("line", [
    GOOD.removesuffix(";y"),                          # 10 fields
    GOOD + ";z",                                      # 12 fields
    GOOD.replace(";x;y", ";x;"),                      # trailing empty field
    GOOD.replace("1234567", "123456"),                # user id of 6
    GOOD.replace("20160401101112", "2016040110111"),  # 13 characters
    GOOD.replace("20160401101112", "2016xx01101112"), # month is no number
    GOOD.replace("20160401101112", "20160431101112"), # no such day
    GOOD.replace("201604", "201603"),
    GOOD.replace("201604", "201610"),
    GOOD.replace("0999|01", "0999|11"),
    "0201|0999|01;",
    ";;;",
])
def test_bad_live_records(spark, line):
    assert clean.filter_live(log(spark, line)).count() == 0


def test_trailing_separators_are_not_fields(spark):
    assert clean.filter_live(log(spark, GOOD + ";;;")).count() == 1


def test_power_records_need_no_field_count(spark):
    rows = clean.filter_power(log(
        spark, "0201|0999|10;20160401000000;1234567", "0201|0999|11;20160401000001;1234567;x",
        "0201|0999|11;20160401000001", "0201|0999|11",
    )).collect()
    assert sorted(r.opens for r in rows) == [False, True]


def test_relaxed_users(spark):
    nine = ";".join(GOOD.split(";")[:9])
    eight = ";".join(GOOD.split(";")[:8]).replace("1234567", "7654321")
    assert [tuple(r) for r in clean.monthly_users(log(spark, nine, eight, GOOD)).collect()] == [
        (201604, 1)]


def test_routes(spark):
    rows = clean.route_events(log(
        spark,
        "0301|0204|03;u;t;x",
        "0301|0306|01;u;2;3;4;5;6;7;t8",
        "0301|1010|05;t;u",
        "0301|0204|04;u;2;3",          # the field is missing
        "0301|0204|03;0;t", "0301|0204|03;u;0", "0301|0204|03;;t", "0301|0204|03;a\tb;t",
        "9999;u;t",
    )).collect()
    assert sorted((r.key_1, r.key_2) for r in rows) == [("u", "t"), ("u", "t"), ("u", "t8")]


def test_names(spark):
    raw = ["", "null", None, "X(pay)", "Y", "(odd)"]
    rows = spark.createDataFrame([(r,) for r in raw], "n string")
    assert [r[0] for r in rows.select(text.clean_channel(F.col("n"))).collect()] == [
        "?", "?", "?", "X", "Y", ""]


@pytest.mark.parametrize("key,by,expected", [
    (201614, -1, 201613), (201601, -1, 201553), (201553, 1, 201601), (202101, -1, 202053),
    (201653, 0, 201701)])
def test_week_shift(spark, key, by, expected):
    rows = spark.createDataFrame([(key,)], "week int")
    assert calendar.shift_week(rows, by).first()[0] == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on that day.
        rows = spark.createDataFrame([("20160313023059",)], "t string")
        ts = text.log_time(F.col("t"))
        cut = calendar.whole_seconds(ts + F.expr("interval '0.75' second"))
        row = rows.select(ts.alias("ts"), cut.alias("cut"), text.time_text(ts).alias("back")).first()
        assert row.ts == row.cut == datetime(2016, 3, 13, 2, 30, 59)
        assert row.back == "20160313023059"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_records_round_trip(spark):
    rows = spark.createDataFrame(
        [("1234567", 201604, 201613, date(2016, 4, 1), 9, "A", "P", 12)],
        "uid string, month int, week int, day date, hour int, channel_name string, "
        "program_name string, seconds long")
    lines = text.tsv_lines(rows)
    assert lines.first()[0] == "1234567\t201604\t201613\t2016-04-01\t9\tA\tP\t12"
    assert records.parse_records(lines, records.LIVE_VIEWING).collect() == rows.collect()


def test_text_form(spark):
    rows = spark.sql("select 1.00005D a, cast(null as double) b, 2.58E7D c, 1.5BD d, true e")
    assert text.tsv_lines(rows).first()[0] == "1.0001\tnull\t25800000.0000\t1.5000\ttrue"


def test_blank_lines_and_exponents(spark):
    rows = spark.createDataFrame(
        [("",), ("month\t201604\t7605\t23931\t2652\t2485\t7438\t847516\t2.58E7\t3169",)],
        "value string")
    parsed = records.parse_records(rows, records.DEMAND_SUMMARY)
    kept = records.summary_of(parsed, "month").collect()
    assert len(kept) == 1 and kept[0].month == 201604 and kept[0].time_in_use == 2.58e7


def test_viewer_placement(spark):
    ids = [str(10**17 + i * 37) for i in range(200)] + ["12", "123456"]
    rows = spark.createDataFrame([(u, i) for i, u in enumerate(ids)], "uid string, n int")
    for spread in (1, 3):
        placed = layout.partition_by_viewer(rows, 5, sort=("uid", "n"), spread=spread)
        found = placed.withColumn("at", F.spark_partition_id()).collect()
        assert len(found) == len(ids)
        assert all(r["at"] // spread == int(r.uid[-6:]) % 5 for r in found)


def test_spread_splits_one_viewer(spark):
    rows = spark.range(1000).select(F.lit("999").alias("uid"), "id")
    placed = layout.partition_by_viewer(rows, 4, spread=8)
    assert placed.select(F.spark_partition_id()).distinct().count() == 8
