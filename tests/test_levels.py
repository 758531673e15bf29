"""Groups and totals from one aggregate equal the reports that join two."""

from datetime import date

import pytest

from airwave.functions.calendar import DAY, MONTH, WEEK
from airwave.operators import flows, kpi, levels, viewing

FIRST, LAST = date(2016, 3, 30), date(2016, 4, 12)


@pytest.fixture(scope="module")
def requests(spark):
    """Requests with equal rows, unlisted and missing names, days without any, users of before."""
    rows = []
    for i in range(240):
        day = date(2016, 3 + (i % 3 > 0), 31 if i % 3 == 0 else 1 + i * 7 % 11)
        show = None if i % 17 == 0 else f"s{i % 9}"
        rows += [(i % 13, 60 * (i % 5), day, show, i % 24, day.isocalendar()[0] * 100 + day.isocalendar()[1], day.year * 100 + day.month, i % 2 == 0)] * (1 + i % 2)
    return spark.createDataFrame(rows, "uid long, seconds long, day date, show_name string, hour int, week int, month int, flag boolean")


@pytest.fixture(scope="module")
def shows(spark):
    kinds = list(kpi.DEMAND.kinds) + ["other"]
    return spark.createDataFrame([(f"s{i}", kinds[i % 3]) for i in range(7)], "show_name string, show_type string")


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("grain", [DAY, WEEK, MONTH])
@pytest.mark.parametrize("one,two", [(levels.type_report, kpi.type_report), (levels.item_report, kpi.item_report)])
def test_periods(spark, requests, shows, grain, one, two):
    counted = kpi.counted_requests(requests, grain)
    base = spark.createDataFrame([(1,), (2,), (50,)], "uid long")
    totals = flows.period_summary(counted, grain, FIRST, LAST, seed_cover=base, look_back=True, demand=True, own_key=True, counted=True)
    in_calendar = requests.filter(requests.day >= FIRST) if grain is DAY else requests
    expected = two(kpi.counted_requests(in_calendar, grain), shows, totals, grain, kpi.DEMAND)
    got = one(counted, shows, grain, FIRST, LAST, kpi.DEMAND, seed_cover=base)
    assert got.dtypes == expected.dtypes and rows_of(got) == rows_of(expected) and rows_of(got)


@pytest.mark.parametrize("one,two", [(levels.hour_type_report, kpi.type_report), (levels.hour_item_report, kpi.item_report)])
def test_demand_hours(requests, shows, one, two):
    from airwave.functions.calendar import HOUR

    seen = kpi.distinct_requests(requests, HOUR)
    cover = flows.period_summary(seen, DAY, FIRST, LAST)
    expected = two(seen, shows, kpi.hour_totals(seen, cover, shows="show_name"), HOUR, kpi.DEMAND)
    got = one(levels.request_piece(seen), shows, FIRST, LAST, kpi.DEMAND)
    assert got.dtypes == expected.dtypes and rows_of(got) == rows_of(expected) and rows_of(got)
    summary = levels.hour_summary(levels.request_piece(seen), FIRST, LAST, kpi.DEMAND)
    assert rows_of(summary) == rows_of(kpi.hour_summary_report(seen, cover, kpi.DEMAND))


def test_live_hours_across_midnight(spark):
    from airwave.functions.calendar import HOUR

    rows = [
        (i % 7, 201604, 201614, date(2016, 4, 4 + i % 5 + (i % 5 > 2) * 2), (i * 5) % 24, f"c{i % 4}", f"p{i % 3}", 1000 * (i % 30))
        for i in range(150)
    ]
    hours = spark.createDataFrame(rows, "uid long, month int, week int, day date, hour int, channel_name string, program_name string, seconds long")
    names = spark.createDataFrame([("c0", kpi.LIVE.kinds[0]), ("c1", kpi.LIVE.kinds[1]), ("c2", "other")], "channel_name string, channel_type string")
    first, last = date(2016, 4, 4), date(2016, 4, 10)  # pieces reach the 11th, and days on which nobody begins
    pieces, cover = viewing.split_hours(hours), flows.period_summary(hours, DAY, first, last)
    totals, one = kpi.hour_totals(pieces, cover), levels.live_pieces(hours)
    for got, expected in (
        (levels.hour_type_report(one, names, first, last, kpi.LIVE), kpi.type_report(pieces, names, totals, HOUR, kpi.LIVE)),
        (levels.hour_item_report(one, names, first, last, kpi.LIVE), kpi.item_report(pieces, names, totals, HOUR, kpi.LIVE)),
        (
            levels.hour_item_report(one, names, first, last, kpi.LIVE, programs=True),
            kpi.item_report(pieces, names, totals, HOUR, kpi.LIVE, programs=True),
        ),
        (levels.hour_summary(one, first, last, kpi.LIVE), kpi.hour_summary_report(pieces, cover, kpi.LIVE)),
    ):
        assert got.dtypes == expected.dtypes and rows_of(got) == rows_of(expected) and rows_of(got)


def test_levels_are_made_in_as_many_tasks_as_the_session_asks_for(spark, requests, shows):
    import re

    for one in (levels.type_report, levels.item_report):
        df = one(kpi.counted_requests(requests, DAY), shows, DAY, FIRST, LAST, kpi.DEMAND)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        below = re.split(r"\n\+- == Initial Plan", plan)[0].split("Generate explode", 1)[1]
        # The first exchange under the levels; merged tasks would read it by an AQEShuffleRead.
        read, exchange = below.split("Exchange ", 1)
        assert "REPARTITION_BY_NUM" in exchange.split("\n", 1)[0] and "AQEShuffleRead" not in read


def final(df):
    import re

    df.collect()
    return re.split(r"\n\+- == Initial Plan", df._jdf.queryExecution().executedPlan().toString())[0]


def test_copies_of_a_dictionary_count_before_they_are_broadcast(spark, requests):
    from pyspark.sql import functions as F

    names = spark.range(20_000).select(F.concat(F.lit("s"), "id").alias("show_name"), F.lit(kpi.DEMAND.kinds[0]).alias("show_type"))
    limits = {f"spark.sql.{x}autoBroadcastJoinThreshold": "2m" for x in ("", "adaptive.")}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        # The names alone are 1 MB, their eight copies are not.
        plan = final(levels.type_report(kpi.counted_requests(requests, DAY), names, DAY, FIRST, LAST, kpi.DEMAND))
    finally:
        for key in limits:
            spark.conf.unset(key)
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_windows_of_a_report_read_tasks_that_are_not_merged(spark, requests, shows):
    import re

    for one in (levels.type_report, levels.item_report):
        plan = final(one(kpi.counted_requests(requests, DAY), shows, DAY, FIRST, LAST, kpi.DEMAND))
        windows = plan.split("Window [")[1:]
        assert len(windows) == 3
        for below in windows:
            read, exchange = below.split("Exchange ", 1)
            how = exchange.split("\n", 1)[0]
            assert "REPARTITION_BY_NUM" in how and "AQEShuffleRead" not in read, how
            # A period is one key for all its groups.
            assert not re.match(r"hashpartitioning\(period#\d+, \d+\)", how)
