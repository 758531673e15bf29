"""Report rules on small hand-made tables."""

from datetime import date

from airwave.functions.calendar import DAY, HOUR, MONTH, WEEK
from airwave.operators import kpi, overview

D = date(2016, 4, 1)
LIVE_ROWS = ("uid string, month int, week int, day date, hour int, channel_name string, "
             "program_name string, seconds long")


def live(spark, *rows):
    full = [(u, 201604, 201613, D, h, c, p, s) for u, h, c, p, s in rows]
    return spark.createDataFrame(full, LIVE_ROWS)


def channels(spark):
    return spark.createDataFrame(
        [("A", "央视频道"), ("A", "卫视频道"), ("B", "卫视频道"), ("C", "other")],
        "channel_name string, channel_type string")


def totals(spark, day=D, users=4, cover=8, minutes=10.0):
    return spark.createDataFrame(
        [(day, users, cover, 1, 1, 2, minutes)],
        "day date, user_num long, cover_user_num long, user_in_num long, user_out_num long, "
        "last_user_num long, time_in_use double")


def test_duplicate_dictionary_names_do_not_multiply(spark):
    rows = live(spark, ("1", 9, "A", "p", 60), ("1", 9, "Z", "p", 60))
    typed = kpi.with_type(rows, channels(spark)).collect()
    assert sorted((r.channel_name, r.channel_type) for r in typed) == [("A", "卫视频道"), ("Z", None)]


def test_channel_report(spark):
    rows = live(spark, ("1", 9, "A", "p", 60), ("1", 10, "A", "q", 60), ("2", 9, "A", "p", 120),
                ("2", 9, "C", "p", 999), ("2", 9, "Z", "p", 999))
    report = kpi.item_report(rows, channels(spark), totals(spark), DAY, kpi.LIVE).collect()
    assert len(report) == 1
    row = report[0]
    assert report[0].asDict() == {
        "day": D, "channel_name": "A", "channel_type": "卫视频道",
        "user_index": round(4 / 1440 / 8 * 10000, 4), "market_pct": 0.4, "cover_pct": 0.5,
        "time_in_use_avg": 2.0, "channel_time_in_use": 4.0, "channel_user_num": 2,
        "time_in_use": 10.0, "user_num": 4}
    assert list(row.asDict())[3:6] == ["user_index", "market_pct", "cover_pct"]


def test_hours_measure_coverage_against_users_reached(spark):
    rows = live(spark, ("1", 9, "A", "p", 60), ("2", 9, "B", "p", 60))
    hours = kpi.hour_totals(rows, totals(spark))
    row = kpi.type_report(rows, channels(spark), hours, HOUR, kpi.LIVE).collect()[0]
    assert (row.cover_pct, row.channel_user_num, row.user_num) == (0.25, 2, 2)


def test_missing_summary_keeps_the_row_and_its_key(spark):
    rows = live(spark, ("1", 9, "A", "p", 60))
    other = totals(spark, day=date(2016, 4, 2))
    row = kpi.item_report(rows, channels(spark), other, DAY, kpi.LIVE).first()
    assert row.day == D and row.user_index is None and row.market_pct is None


def test_programs(spark):
    rows = live(spark, ("1", 9, "A", "p", 60), ("2", 9, "A", "q", 180), ("3", 9, "A", "q", 60))
    hours = kpi.hour_totals(rows, totals(spark))
    report = kpi.item_report(rows, channels(spark), hours, HOUR, kpi.LIVE, programs=True)
    ranked = kpi.ranked(report, ["show_name"]).collect()
    assert [(r.show_name, r.show_user_num, r.show_time_in_use) for r in ranked] == [
        ("q", 2, 4.0), ("p", 1, 1.0)]


DEMAND_ROWS = ("uid string, seconds long, day date, show_name string, hour int, week int, "
               "month int, flag boolean")


def demand(spark, *rows):
    return spark.createDataFrame([(u, s, D, n, h, 201614, 201604, f) for u, s, n, h, f in rows],
                                 DEMAND_ROWS)


def test_equal_views_count_once_in_reports(spark):
    rows = demand(spark, ("1", 60, "x", 9, True), ("1", 60, "x", 9, True), ("1", 60, "x", 9, False))
    assert kpi.distinct_requests(rows, DAY).count() == 1
    assert kpi.distinct_requests(rows, HOUR).count() == 2
    assert kpi.distinct_requests(rows, WEEK).columns == ["uid", "week", "seconds", "show_name"]


def test_requests_per_hour(spark):
    rows = demand(spark, ("1", 6000, "x", 9, True), ("1", 60, "x", 10, False),
                  ("2", 90, "y", 11, True), ("2", 30, "y", 11, True))
    report = {r.hour: r for r in kpi.hour_summary_report(rows, totals(spark), kpi.DEMAND).collect()}
    assert (report[9].request_times, report[9].request_one) == (1, 60.0)
    assert (report[10].request_times, report[10].request_times_avg, report[10].request_one) == (
        None, None, 0.0)
    assert (report[11].request_times, report[11].request_times_avg, report[11].request_one) == (
        2, 2.0, 1.0)
    assert kpi.request_times(rows, ["day", "hour"]).count() == 2


def test_show_share_and_kinds(spark):
    rows = demand(spark, ("1", 60, "x", 9, True), ("1", 60, "y", 9, True), ("2", 60, "z", 9, True))
    names = spark.createDataFrame([("x", "电影"), ("y", "电影"), ("z", "other")],
                                  "show_name string, show_type string")
    hours = kpi.hour_totals(rows, totals(spark), shows="show_name")
    row = kpi.type_report(rows, names, hours, HOUR, kpi.DEMAND).collect()
    assert len(row) == 1 and row[0].show_num_pct == round(2 / 3, 4)
    other = kpi.type_report(rows, names, hours, HOUR, kpi.DEMAND, kinds=("other",)).first()
    assert other.show_type == "other" and other.show_user_num == 1


def test_empty_period_has_null_ratios(spark):
    row = kpi.summary_report(totals(spark, users=0, cover=0, minutes=0.0), DAY, kpi.LIVE).first()
    assert row.cover_pct is None and row.time_in_use_avg is None
    assert row.growth_pct == -1.0 and row.request_times == 0


def summary(spark, grain, rows):
    kind = "date" if grain is DAY else "int"
    return spark.createDataFrame(
        rows, f"{grain.name} {kind}, user_num long, cover_user_num long, user_in_num long, "
        "user_out_num long, last_user_num long, time_in_use double")


def test_overview_adds_shared_periods_and_moves_demand_weeks(spark):
    live_weeks = summary(spark, WEEK, [(201553, 1, 2, 1, 0, 0, 5.0), (201601, 3, 6, 1, 1, 3, 6.0)])
    demand_weeks = summary(spark, WEEK, [(201601, 1, 2, 1, 2, 2, 2.0), (201603, 9, 9, 9, 9, 9, 9.0)])
    rows = overview.overview_report(live_weeks, demand_weeks, WEEK).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.week, row.user_type, row.user_num, row.cover_pct, row.growth_pct) == (
        201553, 0, 2, 0.5, 0.0)
    assert (row.user_in_num, row.user_out_num, row.time_in_use, row.time_in_use_avg) == (
        2, 2, 7.0, 3.5)
    months = summary(spark, MONTH, [(201604, 1, 2, 1, 0, 0, 5.0)])
    assert overview.overview_report(months, months, MONTH).first().growth_pct is None
