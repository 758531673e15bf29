"""The physical plans: what is read, how often it is shuffled, what is broadcast."""

import re

from pyspark.sql import functions as F

from airwave.operators import flows, skew
from airwave.plans import queries


def final(df):
    """The plan as it ended up after a run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # A subquery inside has an initial plan of its own, further indented.
    return re.split(r"\n\+- == Initial Plan", plan)[0]


def executed(spark, sf_dir, name, **conf):
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        return final(queries.QUERIES[name](spark, sf_dir))
    finally:
        for key in conf:
            spark.conf.unset(key)


def planned(spark, sf_dir, name):
    return queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = planned(spark, sf_dir, "live_channel_day")
    assert "PushedFilters: [In(event_type, [click,purchase,view])]" in plan
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert reads and all("value" not in r for r in reads)
    assert any(r == "user_id:bigint,event_type:string" for r in reads)


def test_rows_are_shuffled_once_up_to_the_hourly_sums(spark, sf_dir):
    plan = planned(spark, sf_dir, "dwell_hourly")
    top = plan[: plan.index("Window")]
    assert "Exchange" not in top


def test_windows_per_user_alone_read_grouped_rows(spark, sf_dir):
    plan = planned(spark, sf_dir, "dwell_time")
    windows = re.findall(r"windowspecdefinition\((.*?) ASC", plan)
    inside = r"uid#\d+L, slot#\d+, ts#\d+"
    across = r"uid#\d+L, slot#\d+"
    assert windows and all(re.fullmatch(f"{inside}|{across}", spec) for spec in windows)
    # The latter sort grouped minima or maxima.
    assert plan.count("_edge") > 0


def test_the_three_grains_share_one_shuffle(spark, sf_dir):
    df = flows.all_summaries(queries.live_hours(spark, sf_dir), *queries.live_days(spark, sf_dir))
    assert "ReusedExchange" in final(df)


def test_large_dictionary_is_not_broadcast(spark, sf_dir):
    plan = executed(spark, sf_dir, "demand_show_day",
                    **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                       "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    # No join carries a hint.
    assert plan.count("BroadcastHashJoin") == 0
    assert "SortMergeJoin" in plan


def test_report_and_summary_share_the_per_user_shuffle(spark, sf_dir):
    plan = executed(spark, sf_dir, "live_channel_day")
    windows = plan.count("lead(ts")
    assert windows == 1, plan
    assert "ReusedExchange" in plan


def test_hot_names_and_a_large_dictionary(spark):
    name = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5000))
    rows = spark.range(60000).select("id", name.alias("show_name"))
    names = rows.filter("id % 7 > 0").select("show_name", F.lit("film").alias("show_type")).distinct()
    for how in ("inner", "left"):
        plain, dealt = (skew.lookup(rows, names, how, spread=s) for s in (None, "id"))
        assert plain.exceptAll(dealt.select(*plain.columns)).isEmpty()
        assert plain.count() == dealt.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final(dealt)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(show_name" in plan and "_part" in plan
    hot = F.pmod(F.xxhash64("id"), F.lit(skew.NAME_PARTS))
    shares = rows.filter("show_name = 'hot'").groupBy(hot).count().agg(F.count("*"), F.max("count")).first()
    assert shares[0] == skew.NAME_PARTS and shares[1] < 1.2 * 20000 / skew.NAME_PARTS


def jobs_of(spark, build):
    """How many jobs run while ``build`` is called."""
    tracker, group = spark.sparkContext.statusTracker(), "building"
    spark.sparkContext.setJobGroup(group, group)
    before = len(tracker.getJobIdsForGroup(group))
    build()
    return len(tracker.getJobIdsForGroup(group)) - before


def test_building_a_report_runs_no_query(spark, sf_dir):
    def read():
        for name in ("lineitem", "orders", "customer", "part"):
            spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def reads():
        return jobs_of(spark, lambda: queries.QUERIES["demand_type_month"](spark, sf_dir))

    # Each read of a table looks up its schema: one job, and orders is read for its days too.
    assert jobs_of(spark, read) == 4 and reads() <= 6


def scans(plan, columns):
    return len(re.findall(rf"FileScan parquet \[[^\]]*({columns})", plan))


def test_demand_reports_read_the_facts_once(spark, sf_dir):
    for name in ("demand_summary_week", "demand_prepare_day"):
        plan = executed(spark, sf_dir, name)
        assert scans(plan, "l_orderkey") == 1 and "ReusedExchange" in plan, name
    for name in ("demand_show_day", "demand_type_month", "fix_week_type"):
        # Groups and totals are levels of one aggregate: nothing has to be shared.
        plan = executed(spark, sf_dir, name)
        assert scans(plan, "l_orderkey") == 1, name


def test_frame_totals_come_from_one_scan(spark, sf_dir):
    plan = executed(spark, sf_dir, "all_time_channel")
    assert len(re.findall(r"FileScan parquet", plan)) == 1 and plan.count("split(") == 1


def test_hour_reports_read_the_events_once_for_each_kind(spark, sf_dir):
    for name, most in (("live_show_hour", 4), ("live_type_hour", 4), ("demand_show_hour", 3)):
        plan = executed(spark, sf_dir, name)
        assert len(re.findall(r"FileScan parquet", plan)) <= most, name


def test_requests_are_joined_in_as_many_tasks_as_the_session_asks_for(spark, sf_dir):
    for name in ("demand_show_day", "fix_week_type", "demand_summary_day"):
        plan = executed(spark, sf_dir, name,
                        **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                           "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
        for side in re.split(r"SortMergeJoin \[l_orderkey", plan)[1].split("Sort [")[1:3]:
            assert "orderkey" in side and "AQEShuffleRead" not in side.split("Exchange ", 1)[0], name
