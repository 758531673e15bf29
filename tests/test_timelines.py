"""A log measured in batches gives the viewing of the whole log."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airwave.operators import skew, viewing
from airwave.operators.timelines import State, carried, last_power, lines, rest, settled

T0 = datetime(2016, 4, 1, 22, 0, 0)
LIVE_TYPE = "uid string, ts timestamp_ntz, channel_name string, program_name string"
POWER_TYPE = "uid string, ts timestamp_ntz, opens boolean"


def at(second):
    return T0 + timedelta(seconds=second)


def found(rows):
    return sorted((r.uid, r.ts, r.channel_name, r.seconds) for r in rows.collect())


def held(df):
    """The rows as a table of their own, so that batches don't pile up in one plan."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def in_batches(live, power, cuts, heavy=None, **options):
    """Viewing over the stretches between ``cuts``, and the largest number of carried rows of a user."""
    state, out, most = None, [], 0
    for low, high in zip([None, *cuts], [*cuts, None]):
        def part(df):
            df = df if low is None else df.filter(F.col("ts") >= at(low))
            return df if high is None else df.filter(F.col("ts") < at(high))

        marked = held(lines(part(live), part(power), state, heavy=heavy, **options))
        out += found(settled(marked))
        state = State(held(carried(marked)), held(last_power(part(power), state, options.get("tie"))))
        counts = state.live.groupBy("uid").count().agg(F.max("count")).first()[0]
        most = max(most, counts or 0)
    return sorted(out + found(rest(state))), most


def whole(live, power, **options):
    off = viewing.shutdown_times(power, options.get("tie"), options.get("draw"))
    return found(viewing.dwell_times(live, off, options.get("tie")))


def logs(spark, live, power):
    return (
        spark.createDataFrame([(u, at(s), c, "p") for u, s, c in live], LIVE_TYPE),
        spark.createDataFrame([(u, at(s), o) for u, s, o in power], POWER_TYPE),
    )


def random_log(seed, users=12, span=40_000):
    """Dense records, so that possible shutdowns fall between, on and after live records."""
    draw = random.Random(seed)
    live, power = [], []
    for i in range(users):
        uid = f"{7654321 + i}"
        live += [(uid, draw.randrange(0, span, 60), f"C{draw.randrange(4)}") for _ in range(60)]
        power += [(uid, draw.randrange(0, span, 60), draw.random() < 0.4) for _ in range(40)]
    live += [("only_live", draw.randrange(span), "A") for _ in range(10)]
    power += [("only_power", draw.randrange(span), True) for _ in range(10)]
    return live, power


@pytest.mark.parametrize("seed", range(2))
def test_batches_equal_the_whole(spark, seed):
    live, power = logs(spark, *random_log(seed))
    draw = random.Random(seed + 100)
    cuts = sorted(draw.sample(range(0, 40_000), 3))
    got, most = in_batches(live, power, cuts)
    assert got == whole(live, power)
    assert most <= 2


def test_batches_with_a_heavy_user(spark):
    live, power = random_log(9, users=4, span=90_000)
    draw = random.Random(1)
    live += [("7654321", draw.randrange(90_000), "H") for _ in range(400)]
    live, power = logs(spark, live, power)
    heavy = skew.heavy_keys(live, limit=200)
    assert [r.uid for r in heavy.collect()] == ["7654321"]
    got, most = in_batches(live, power, [30_030, 61_000], heavy=heavy)
    assert got == whole(live, power) and most <= 2


def test_a_shutdown_inside_the_earlier_batch_that_a_later_one_decides(spark):
    wait = int((viewing.shutdown_times(logs(spark, [], [("7", 0, False), ("7", 9000, True)])[1])
                .first().ts - at(0)).total_seconds())
    live = [("7", -100, "A"), ("7", wait + 500, "B"), ("7", wait + 800, "C")]
    for opens, first in ((True, wait + 100), (False, wait + 600)):
        rows, power = logs(spark, live, [("7", 0, False), ("7", 9000, opens)])
        got, most = in_batches(rows, power, [2000, 5000])
        assert got == whole(rows, power)
        assert got[0] == ("7", at(-100), "A", first) and most == 2


def test_empty_batches_and_an_empty_log(spark):
    live, power = logs(spark, [("7", 0, "A"), ("7", 900, "B")], [])
    assert in_batches(live, power, [100, 200, 300])[0] == [("7", at(0), "A", 900)]
    assert in_batches(*logs(spark, [], []), [5])[0] == []


def test_rows_without_a_user_drop_out(spark):
    live, power = logs(spark, [(None, 0, "A"), (None, 900, "B")], [(None, 0, True), (None, 50, True)])
    assert in_batches(live, power, [100]) == ([], 0)


def test_tie_columns_go_along(spark):
    live, power = logs(spark, *random_log(5, users=3))
    live = live.withColumn("event_id", F.xxhash64("uid", "ts", "channel_name"))
    power = power.withColumn("event_id", F.xxhash64("uid", "ts", "opens"))
    got, _ = in_batches(live, power, [7_000, 22_222], tie=["event_id"], draw=3)
    assert got == whole(live, power, tie=["event_id"], draw=3)
