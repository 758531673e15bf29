"""Text exports and table loads, through real files."""

import glob
import gzip
import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from airwave.sinks import tables, text
from airwave.sources import logs, records


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


def report(spark, *rows):
    return spark.createDataFrame(
        [(date(2016, 1, d), n) for d, n in rows], "day date, user_num long")


def stored(spark, path):
    return sorted((r.user_type, r.grain, r.day.day, r.user_num)
                  for r in spark.read.parquet(path).collect())


def test_tsv_files(spark, folder):
    rows = spark.range(100).select("id", (F.col("id") / 3).alias("third"))
    text.write_tsv(rows, f"{folder}/one", files=1)
    text.write_tsv(rows, f"{folder}/five", files=5, gzip=True)
    assert len(glob.glob(f"{folder}/one/part-*.txt")) == 1
    files = glob.glob(f"{folder}/five/part-*.gz")
    assert len(files) == 5
    lines = [line for f in files for line in gzip.open(f, "rt")]
    assert "1\t0.3333\n" in lines and len(lines) == 100
    back = logs.read_lines(spark, f"{folder}/five", partitions=7)
    assert back.count() == 100 and back.rdd.getNumPartitions() == 7


def test_sorted_summary(spark, folder):
    rows = [("week", "201613", 1), ("day", "2016-04-02", 1), ("day", "2016-04-01", 1),
            ("day", "2016-04-01", 1)]
    summaries = spark.createDataFrame(rows, "grain string, period string, user_num long")
    text.write_sorted_summary(summaries, f"{folder}/s")
    (path,) = glob.glob(f"{folder}/s/part-*")
    assert [line.split("\t")[1] for line in open(path)] == ["2016-04-01", "2016-04-02", "201613"]


def test_reports(spark, folder):
    rows = report(spark, *[(d, 1) for d in range(1, 9)]).repartition(4, "day")
    text.write_report(rows, f"{folder}/summary")
    text.write_report(rows.filter("day = '2016-01-03'"), f"{folder}/channel", items=True)
    assert len(glob.glob(f"{folder}/summary/part-*")) == 1
    found = [line for f in glob.glob(f"{folder}/channel/part-*") for line in open(f)]
    assert found == ["2016-01-03\t1\n"]


def test_a_load_computes_its_rows_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    path = f"{folder}/t"
    for n in (1, 2):
        rows = report(spark, (1, 1), (5, n)).mapInArrow(counted, "day date, user_num long")
        tables.replace_load(rows, path, 2, "day", date(2015, 12, 31))
        assert seen.value == 2 * n
    assert stored(spark, path) == [(2, "day", 1, 1), (2, "day", 5, 2)]


def test_a_load_that_fails_leaves_the_table(spark, folder):
    path = f"{folder}/t"
    tables.replace_load(report(spark, (5, 1)), path, 2, "day", date(2016, 1, 1))
    bad = report(spark, (6, 1)).withColumn("user_num", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        tables.replace_load(bad, path, 2, "day", date(2016, 1, 1))
    assert stored(spark, path) == [(2, "day", 5, 1)]
    assert not glob.glob(f"{path}.staging/*")


def test_append_load(spark, folder):
    parts = [report(spark, (1, n)).withColumns({"user_type": F.lit(n), "grain": F.lit("day")})
             for n in (0, 1)]
    tables.append_load(parts, f"{folder}/t")
    tables.append_load(parts[:1], f"{folder}/t")
    assert stored(spark, f"{folder}/t") == [(0, "day", 1, 0), (0, "day", 1, 0), (1, "day", 1, 1)]


def test_replace_load_touches_only_its_slice(spark, folder):
    path = f"{folder}/t"
    tables.replace_load(report(spark, (1, 1), (5, 1)), path, 2, "day", date(2016, 1, 2))
    tables.replace_load(report(spark, (1, 7)), path, 1, "day", date(2016, 1, 2))
    tables.replace_load(report(spark, (6, 2)), path, 2, "day", date(2016, 1, 2))
    assert stored(spark, path) == [(1, "day", 1, 7), (2, "day", 1, 1), (2, "day", 6, 2)]


def test_replace_load_with_nothing_empties_the_slice(spark, folder):
    path = f"{folder}/t"
    for kind in (1, 2):
        tables.replace_load(report(spark, (5, 1)), path, kind, "day", date(2016, 1, 2))
    tables.replace_load(report(spark), path, 2, "day", date(2016, 1, 2))
    assert stored(spark, path) == [(1, "day", 5, 1)]


def test_summaries_prune_to_one_grain(spark, folder):
    rows = [("week", "201613"), ("day", "2016-04-01"), ("month", "201604")]
    tables.write_summaries(spark.createDataFrame(rows, "grain string, period string"), f"{folder}/s")
    kept = records.summary_of(spark.read.parquet(f"{folder}/s"), "week")
    assert [r.week for r in kept.collect()] == [201613]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(grain" in plan
