"""Bad lines of each layout are dropped and counted."""

import pytest

from airwave.sources import records

GOOD = {
    "live": (records.LIVE_VIEWING, "u1\t201609\t201636\t2016-09-05\t3\tc\tp\t60"),
    "demand": (records.DEMAND_VIEWING, "u1\t60\t2016-09-05\ts\t3\t201636\t201609\ttrue"),
    "summary": (records.LIVE_SUMMARY, "day\t2016-09-05\t1\t2\t3\t4\t5\t6.5"),
    "hours": (records.HOUR_SUMMARY, "2016-09-05\t3\t1\t5\t0.5\t6.5"),
}


@pytest.mark.parametrize("name", GOOD)
def test_bad_lines_are_dropped(spark, name):
    layout, good = GOOD[name]
    fields = good.split("\t")
    numeric = [i for i, (n, kind) in enumerate(layout) if kind != "string" and n not in records.OPTIONAL]
    bad = ["\t".join("x?" if j == i else f for j, f in enumerate(fields)) for i in numeric]
    short = ["\t".join(fields[:2]), "\t".join(fields[:-1])]
    lines = spark.createDataFrame([(x,) for x in [good, *bad, *short, ""]], "value string")
    assert records.parse_records(lines, layout).count() == 1
    assert records.dropped_lines(lines, layout) == len(bad) + len(short)


def test_bad_prototype_lines_are_dropped(spark):
    lines = spark.createDataFrame([("u a b 5.5 20160905 c ch 7",), ("u a b x 20160905 c ch 7",), ("u a b",)], "value string")
    assert records.parse_prototype(lines).count() == 1
