"""Period summaries against sets kept in a loop, the way one would do it by hand."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from airwave.functions.calendar import DAY, MONTH, WEEK
from airwave.operators import extracts, flows, kpi
from airwave.plans import queries

ROWS = "uid string, day date, seconds long, show_name string, flag boolean"


def start(grain, day):
    if grain is MONTH:
        return day.replace(day=1)
    return day - timedelta(days=day.weekday()) if grain is WEEK else day


def after(grain, period):
    if grain is MONTH:
        return (period + timedelta(days=32)).replace(day=1)
    return period + timedelta(days=7 if grain is WEEK else 1)


def key(grain, period):
    if grain is MONTH:
        return period.year * 100 + period.month
    if grain is WEEK:
        year, week, _ = period.isocalendar()
        return year * 100 + week
    return period


def by_hand(rows, grain, first, last, cover=(), previous=(), look_back=False):
    period, end = start(grain, first), start(grain, last)
    known, old = set(cover), set(previous)
    if look_back:
        old |= {r[0] for r in rows if after(grain, start(grain, r[1])) == period}
    found = []
    while period <= end:
        mine = [r for r in rows if start(grain, r[1]) == period]
        now = {r[0] for r in mine}
        known |= now
        found.append((key(grain, period), len(now), len(known), len(now - old), len(old - now),
                      len(old), sum(r[4] for r in mine), sum(r[2] for r in mine) / 60,
                      len({r[3] for r in mine})))
        old, period = now, after(grain, period)
    return found


def sample(seed, users=25, days=100):
    draw = random.Random(seed)
    rows = []
    for _ in range(400):
        uid = "hot" if draw.random() < 0.34 else f"u{draw.randrange(users)}"
        day = date(2016, 11, 10) + timedelta(days=draw.randrange(days))
        if day.day != 24:  # days without anybody
            rows.append((uid, day, draw.randrange(1, 5000), f"s{draw.randrange(9)}",
                         draw.random() < 0.5))
    return rows


@pytest.mark.parametrize("grain", [DAY, WEEK, MONTH], ids=lambda g: g.name)
@pytest.mark.parametrize("look_back", [False, True])
@pytest.mark.parametrize("seeded", [False, True])
def test_summary_equals_sets(spark, grain, look_back, seeded):
    rows = sample(7)
    cover = ["u1", "u2", "u3", "x1", "x2", "hot"] if seeded else []
    previous = ["u2", "x1", "u9"] if seeded else []
    first, last = date(2016, 12, 1), date(2017, 2, 3)
    frame = spark.createDataFrame(rows, ROWS)
    uids = [spark.createDataFrame([(u,) for u in us * 2], "uid string") if us else None
            for us in (cover, previous)]
    summary = flows.period_summary(
        frame, grain, first, last, seed_cover=uids[0], seed_previous=uids[1],
        look_back=look_back, demand=True)
    got = [tuple(r) for r in summary.orderBy(grain.name).collect()]
    assert got == by_hand(rows, grain, first, last, cover, previous, look_back)


def test_invariants(spark, sf_dir):
    table = flows.all_summaries(queries.live_hours(spark, sf_dir), *queries.live_days(spark, sf_dir))
    rows = table.orderBy("grain", "period").collect()
    final = set()
    for grain in ("day", "week", "month"):
        mine = [r for r in rows if r.grain == grain]
        assert all(r.user_num == r.last_user_num + r.user_in_num - r.user_out_num for r in mine)
        for a, b in zip(mine, mine[1:]):
            assert b.last_user_num == a.user_num and b.cover_user_num >= a.cover_user_num
        final.add(mine[-1].cover_user_num)
    assert len(final) == 1


def test_own_key(spark):
    rows = spark.createDataFrame([("a", date(2016, 4, 1), 60, 201614)],
                                 "uid string, day date, seconds long, week int")
    days = (date(2016, 4, 4), date(2016, 4, 4))
    own, of_day = (
        flows.period_summary(rows, WEEK, *days, own_key=own).first() for own in (True, False))
    assert (own.week, own.user_num) == (201614, 1)
    assert (of_day.week, of_day.user_num) == (201614, 0)


def test_summary_of_rows_summed_per_period(spark, sf_dir):
    hours = queries.live_hours(spark, sf_dir)
    for grain in (DAY, WEEK, MONTH):
        summed = kpi.per_user(hours, grain, ["channel_name"])
        a, b = (flows.period_summary(r, grain, *queries.live_days(spark, sf_dir), own_key=own)
                for r, own in ((summed, True), (hours, False)))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_moved_users(spark):
    rows = spark.createDataFrame(
        [("a", date(2016, 4, 1)), ("a", date(2016, 4, 2)), ("b", date(2016, 4, 1))],
        "uid string, day date")
    enter = flows.moved_users(rows, DAY).collect()
    leave = flows.moved_users(rows, DAY, entering=False).collect()
    assert sorted(map(tuple, enter)) == [("a", date(2016, 4, 1)), ("b", date(2016, 4, 1))]
    assert sorted(map(tuple, leave)) == [("a", date(2016, 4, 3)), ("b", date(2016, 4, 2))]


@pytest.mark.parametrize("n", [0, 1, 7, 999, 1000, 3000, 9999, 10000, 20000])
def test_least_users(spark, n):
    users = spark.range(10000).select((F.col("id") * 7919 % 100003).cast("string").alias("uid"))
    got = [r.uid for r in extracts.least_users(users.unionByName(users), n).collect()]
    expected = sorted({i * 7919 % 100003 for i in range(10000)})[:n]
    assert sorted(map(int, got)) == expected


def test_least_users_with_odd_ids(spark):
    users = spark.createDataFrame([("b",), ("10",), ("9",), ("a",)], "uid string")
    assert {r.uid for r in extracts.least_users(users, 3).collect()} == {"9", "10", "a"}
    assert extracts.least_users(users.filter("uid > 'a'"), 1).count() == 1
