"""Shutdowns, dwell and splitting, by hand-made cases and against a plain loop."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airwave.operators import skew, viewing

T0 = datetime(2016, 4, 1, 10, 0, 0)
LIVE_TYPE = "uid string, ts timestamp_ntz, channel_name string, program_name string"
POWER_TYPE = "uid string, ts timestamp_ntz, opens boolean"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def live(spark, rows):
    return spark.createDataFrame([(u, at(s), c, "p") for u, s, c in rows], LIVE_TYPE)


def power(spark, rows):
    return spark.createDataFrame([(u, at(s), o) for u, s, o in rows], POWER_TYPE)


def no_shutdowns(spark):
    return spark.createDataFrame([], LIVE_TYPE)


def dwell(spark, rows, shutdowns=None):
    off = shutdowns if shutdowns is not None else no_shutdowns(spark)
    result = viewing.dwell_times(live(spark, rows), off)
    return sorted((r.uid, r.channel_name, r.seconds) for r in result.collect())


def test_dwell_bounds(spark):
    gaps = [4, 5, 36000, 36001]
    rows = [("1234567%d" % i, s, c) for i, g in enumerate(gaps) for s, c in ((0, "A"), (g, "B"))]
    assert [s for _, _, s in dwell(spark, rows)] == [5, 36000]


def test_last_record_has_no_dwell(spark):
    assert dwell(spark, [("1", 0, "A")]) == []


def test_dwell_across_hours_days_and_empty_hours(spark):
    rows = [("1", 3500, "A"), ("1", 3700, "B"), ("1", 3700 + 30000, "C"), ("2", 9999, "A")]
    assert dwell(spark, rows) == [("1", "A", 200), ("1", "B", 30000)]


def test_same_second_orders_by_name(spark):
    rows = [("1", 0, "B"), ("1", 0, "A"), ("1", 60, "C")]
    assert dwell(spark, rows) == [("1", "B", 60)]


def test_shutdown_ends_a_dwell_and_has_none(spark):
    off = spark.createDataFrame([("1", at(100), "_", "_")], LIVE_TYPE)
    assert dwell(spark, [("1", 0, "A"), ("1", 500, "B")], off) == [("1", "A", 100)]


def test_shutdown_is_the_event_before_a_switch_on(spark):
    rows = [("7654321", 0, True), ("7654321", 600, False), ("7654321", 9000, True),
            ("7654321", 9600, True), ("8888888", 0, True)]
    found = viewing.shutdown_times(power(spark, rows)).orderBy("ts").collect()
    assert len(found) == 2
    for row, base in zip(found, (600, 9000)):
        wait = (row.ts - at(base)).total_seconds()
        assert wait % 60 == 0 and 0 <= wait <= 540
        assert (row.channel_name, row.program_name) == ("_", "_")


def test_drawn_offsets_repeat_for_one_draw(spark):
    rows = power(spark, [("7654321", i * 4000, True) for i in range(50)])
    first, again, other = (
        sorted(r.ts for r in viewing.shutdown_times(rows, draw=n).collect()) for n in (1, 1, 2)
    )
    assert first == again != other


def loop_dwell(rows):
    """What the job computes, for rows (uid, second, channel, off)."""
    by_user = defaultdict(list)
    for uid, second, channel, off in rows:
        by_user[uid].append((second, off, channel))
    found = []
    for uid, events in by_user.items():
        events.sort()
        for (second, off, channel), (after, _, _) in zip(events, events[1:]):
            if not off and 5 <= after - second <= 36000:
                found.append((uid, channel, second, after - second))
    return sorted(found)


@pytest.mark.parametrize("seed,limit", [(1, 900), (2, 900), (2, 100_000)])
def test_dwell_equals_a_loop_with_one_user_holding_a_third(spark, seed, limit):
    draw = random.Random(seed)
    rows = []
    for i in range(3000):
        uid = "hot" if i % 3 == 0 else f"u{draw.randrange(40)}"
        off = draw.random() < 0.1
        rows.append((uid, draw.randrange(400000), "_" if off else f"C{i}", int(off)))
    data = spark.createDataFrame([(u, at(s), c, "p") for u, s, c, _ in rows], LIVE_TYPE)
    heavy = skew.heavy_keys(data, limit=limit)
    assert [r.uid for r in heavy.collect()] == (["hot"] if limit == 900 else [])
    result = viewing.dwell_times(
        data.filter("channel_name <> '_'"), data.filter("channel_name = '_'"), heavy=heavy
    )
    got = sorted(
        (r.uid, r.channel_name, int((r.ts - T0).total_seconds()), r.seconds)
        for r in result.collect()
    )
    assert got == loop_dwell(rows)
    summed = viewing.hourly_viewing(result)
    assert summed.agg(F.sum("seconds")).first()[0] == sum(r[3] for r in got)
    keys = ["uid", "day", "hour", "channel_name", "program_name"]
    assert summed.groupBy(*keys).count().filter("count > 1").isEmpty()


def test_shutdowns_of_a_heavy_user(spark):
    rows = [("7654321", i * 977 + (i % 7) * 5000, i % 3 == 0) for i in range(300)]
    rows += [("7000000", i * 5000, i % 2 == 0) for i in range(20)]
    data = power(spark, rows)
    plain, cut = (
        sorted(map(tuple, viewing.shutdown_times(data, heavy=skew.heavy_keys(data, limit=n)).collect()))
        for n in (10**6, 100)
    )
    assert plain == cut and len(plain) > 90


def hours(spark, rows):
    layout = ("uid string, month int, week int, day date, hour int, channel_name string, "
              "program_name string, seconds long")
    cut = [(u, 0, 0, datetime.fromisoformat(d).date(), h, "A", "p", s) for u, d, h, s in rows]
    return spark.createDataFrame(cut, layout)


def pieces(spark, rows):
    found = viewing.split_hours(hours(spark, rows)).collect()
    return sorted((str(r.day), r.hour, r.week, r.month, r.seconds) for r in found)


@pytest.mark.parametrize("seconds,expected", [(3600, [3600]), (3601, [3600, 1]),
                                              (7200, [3600, 3600]), (12, [12])])
def test_split_sizes(spark, seconds, expected):
    assert [p[4] for p in pieces(spark, [("1", "2016-04-01", 10, seconds)])] == expected


def test_split_crosses_midnight_week_and_year(spark):
    assert pieces(spark, [("1", "2015-12-31", 23, 4000)]) == [
        ("2015-12-31", 23, 201553, 201512, 3600), ("2016-01-01", 0, 201553, 201601, 400)]
    assert pieces(spark, [("1", "2016-04-03", 23, 3700)]) == [
        ("2016-04-03", 23, 201613, 201604, 3600), ("2016-04-04", 0, 201614, 201604, 100)]


def test_single_digit_hours_split_too(spark):
    assert [(p[1], p[4]) for p in pieces(spark, [("1", "2016-04-01", 2, 4000)])] == [
        (2, 3600), (3, 400)]


def test_split_keeps_the_seconds(spark, sf_dir):
    from airwave.plans import queries

    whole = queries.live_hours(spark, sf_dir)
    cut = viewing.split_hours(whole)
    top, total = cut.agg(F.max("seconds"), F.sum("seconds")).first()
    assert top <= 3600
    assert total == whole.agg(F.sum("seconds")).first()[0]
