"""Tables stored by user: no shuffle of the stream, and users reached so far as stored state."""

import random
import re
import tempfile
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airwave.functions.calendar import DAY, MONTH, WEEK
from airwave.operators import flows, skew, viewing
from airwave.sinks import history, viewers

T0 = datetime(2016, 4, 1, 10, 0, 0)
EVENT = "uid string, ts timestamp_ntz, channel_name string, program_name string"


def folder():
    return tempfile.mkdtemp(prefix="run-")


def events(spark, seed=1, n=3000):
    """A live log and shutdowns in which one user holds a third of the rows."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        uid = "hot" if i % 3 == 0 else f"u{draw.randrange(40)}"
        name = "_" if draw.random() < 0.1 else f"C{i}"
        rows.append((uid, T0 + timedelta(seconds=draw.randrange(400_000)), name, "p"))
    rows.append((None, T0, "C", "p"))
    data = spark.createDataFrame(rows, EVENT)
    return data.filter("channel_name <> '_'"), data.filter("channel_name = '_'")


def final(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.split(r"\n\+- == Initial Plan", plan)[0]


@pytest.mark.parametrize("limit", [900, 100_000])
def test_stored_stream_gives_the_same_viewing_without_a_shuffle(spark, limit):
    live, off = events(spark)
    heavy = skew.heavy_keys(live.unionByName(off), limit=limit)
    assert [r.uid for r in heavy.collect()] == (["hot"] if limit == 900 else [])
    at = folder()
    viewers.write_stream(live, off, at, buckets=6, heavy=heavy)
    assert viewers.buckets_of(spark, at) == 6
    dwell = viewing.dwell_of_stored(viewers.read_stream(spark, at))
    columns = ["uid", "ts", "channel_name", "program_name", "seconds"]
    got, plain = (
        sorted(map(tuple, df.select(*columns).collect()))
        for df in (dwell, viewing.dwell_times(live, off, heavy=heavy))
    )
    assert got == plain and got
    plan = final(viewing.hourly_viewing(dwell))
    assert "Bucketed: true" in plan
    if limit == 900:
        # A heavy user's hours, one row each, go to a window per user and back; the stream does not.
        exchanged = re.findall(r"Exchange \w+\((.*?)\)", plan)
        assert sum(e.startswith("uid") for e in exchanged) <= 2
        largest = viewers.read_stream(spark, at).groupBy(F.spark_partition_id()).count()
        assert largest.agg(F.max("count")).first()[0] < 900
    else:
        assert "Exchange" not in plan


def test_a_stream_is_stored_once(spark):
    live, off = events(spark, n=30)
    at = folder()
    viewers.write_stream(live, off, at, buckets=2)
    with pytest.raises(FileExistsError):
        viewers.write_stream(live, off, at, buckets=2)


def test_empty_stream(spark):
    nothing = spark.createDataFrame([], EVENT)
    at = folder()
    assert viewers.read_stream(spark, at).isEmpty()
    viewers.write_stream(nothing, nothing, at, buckets=2)
    assert viewing.dwell_of_stored(viewers.read_stream(spark, at)).isEmpty()


def views(spark, seed=3):
    """Rows (uid, day, seconds) of April to July, with days nobody watches and a hot user."""
    draw = random.Random(seed)
    rows = []
    for i in range(1500):
        uid = "hot" if i % 3 == 0 else f"u{draw.randrange(120)}"
        day = date(2016, 4, 1) + timedelta(days=draw.randrange(120))
        if day.day not in (12, 13):
            rows.append((uid, day, draw.randrange(1, 5000)))
    return spark.createDataFrame(rows, "uid string, day date, seconds long")


HALVES = [("2016-04-01", "2016-06-01"), ("2016-06-02", "2016-07-31")]


def rows_of(df):
    return {r[0]: tuple(r) for r in df.collect()}


def test_two_batches_equal_one_run_and_the_second_reads_its_own_days(spark):
    rows = views(spark)
    base = spark.createDataFrame([("u1",), ("u2",), ("never",)], "uid string")
    at = folder()
    history.begin(base, at, buckets=3)
    got = {grain.name: {} for grain in (DAY, WEEK, MONTH)}
    for first, last in HALVES:
        history.extend(rows, at, first, last, buckets=3)
        for grain in (DAY, WEEK, MONTH):
            got[grain.name] |= rows_of(history.summary(spark, at, grain, first, last))
    for grain in (DAY, WEEK, MONTH):
        whole = flows.period_summary(rows, grain, "2016-04-01", "2016-07-31", seed_cover=base, look_back=True)
        assert got[grain.name] == rows_of(whole), grain.name

    for grain, oldest in ((DAY, "2016-06-01"), (WEEK, "2016-05-23"), (MONTH, "2016-05-01")):
        files = history.needed_days(spark, at, grain, *HALVES[1]).select("uid", F.input_file_name().alias("f"))
        days = {re.search(r"day=([0-9-]+)", r.f)[1] for r in files.select("f").distinct().collect()}
        assert min(days) >= oldest
        scan = final(history.needed_days(spark, at, grain, *HALVES[1]))
        assert re.search(r"PartitionFilters: \[[^]]*day", scan)


def test_a_batch_run_again_changes_nothing_and_an_old_one_is_refused(spark):
    rows = views(spark, seed=4)
    at = folder()
    for first, last in (*HALVES, HALVES[1]):
        history.extend(rows, at, first, last, buckets=3)
    seen = history.first_seen(spark, at)
    firsts = {r.uid: r.day for r in rows.groupBy("uid").agg(F.min("day").alias("day")).collect()}
    assert sorted(map(tuple, seen.collect())) == sorted(firsts.items())
    stored = history.user_days(spark, at)
    assert stored.count() == rows.select("uid", "day").distinct().count()
    with pytest.raises(ValueError):
        history.extend(rows, at, *HALVES[0], buckets=3)


def test_the_table_of_first_days_is_not_shuffled(spark):
    rows = views(spark, seed=5)
    at = folder()
    history.extend(rows, at, *HALVES[0], buckets=8)
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    usual = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        plan = final(history.new_users(rows, history.first_seen(spark, at)))
    finally:
        for key, value in usual.items():
            spark.conf.set(key, value)
    assert "Bucketed: true" in plan
    # The batch's own users move, to the table's buckets, and nothing else does.
    assert re.findall(r"Exchange (\w+)\(", plan) == ["hashpartitioning"]
