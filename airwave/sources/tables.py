"""The audience tables, projected from the generic tables of the checks.

Set-top-box logs do not come with those tables, so each log or record table here is a
projection of ``events``, ``orders`` and ``lineitem``, and the dictionaries are of ``part``
or constants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.functions.calendar import month_key, week_key, whole_seconds, with_calendar_keys
from airwave.functions.text import clean_channel, known_or_mark, time_text
from airwave.operators.skew import session_tasks
from airwave.sources.logs import HEARTBEAT, KEY_FIELDS, LIVE, OPEN

VIEWS = ("view", "click", "purchase")
POWER = ("signup", "error")
REQUESTS = ("purchase", "signup")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def first_and_last(spark: SparkSession, sf_dir: str, name: str, time: str) -> tuple[Column, Column]:
    """The first and the last day of a table's times: one scan of that column, aggregated."""
    days = table(spark, sf_dir, name).agg(
        F.struct(F.min(time).cast("date").alias("first"), F.max(time).cast("date").alias("last")).alias("days")
    ).scalar()
    return days["first"], days["last"]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("uid"),
        whole_seconds(F.col("ts")).alias("ts"),
        "event_type",
        "value",
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
    )


def _raw_channel(k: Column) -> Column:
    named = F.concat(F.lit("CH"), k % 20, F.when(k % 3 == 0, F.lit("(pay)")).otherwise(""))
    return F.when(k % 17 == 0, F.lit("")).otherwise(named)


def _raw_program(k: Column) -> Column:
    return F.when(k % 29 == 0, F.lit("null")).otherwise(F.concat(F.lit("P"), k))


def _named(events: DataFrame) -> DataFrame:
    k = F.col("k")
    return events.withColumns(
        {"channel_raw": _raw_channel(k), "program_raw": _raw_program(k)}
    )


def live_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live records (event_id, uid, ts, channel_name, program_name)."""
    views = _events(spark, sf_dir).filter(F.col("event_type").isin(*VIEWS))
    return _named(views).select(
        "event_id",
        "uid",
        "ts",
        clean_channel(F.col("channel_raw")).alias("channel_name"),
        known_or_mark(F.col("program_raw")).alias("program_name"),
    )


def raw_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel and program names as the log has them."""
    return _named(_events(spark, sf_dir)).select("event_id", "channel_raw", "program_raw")


def power_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heartbeats and switch-ons (event_id, uid, ts, opens)."""
    kind = F.col("event_type")
    return (
        _events(spark, sf_dir)
        .filter(kind.isin(*POWER))
        .select("event_id", "uid", "ts", (kind == "signup").alias("opens"))
    )


def raw_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as ``;`` lines, with too short user ids and cut lines among them."""
    k, kind = F.col("k"), F.col("event_type")
    code = F.when(kind == "signup", OPEN).when(kind == "error", HEARTBEAT).otherwise(LIVE)
    uid = F.when(k % 13 == 0, F.col("uid") + 100000).otherwise(F.col("uid") + 80000000000)
    last = F.when(k % 19 == 0, F.lit("")).otherwise("z")
    fields = [code, time_text(F.col("ts")), uid, F.lit("a"), F.lit(""), F.lit("b"), F.lit("c"),
              _raw_channel(k), _raw_program(k), F.lit(""), last]
    line = F.concat_ws(";", *[f.cast("string") for f in fields])
    return _events(spark, sf_dir).select(line.alias("value"))


def routed_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of many event codes; the fields differ by position, some are 0 or empty."""
    k = F.col("k")
    codes = sorted(code for group in KEY_FIELDS.values() for code in group)
    codes.append("0301|9999|99")
    code = F.get(F.array(*[F.lit(c) for c in codes]), k % len(codes))
    fields = [code, *[(F.col("uid") * 10 + i) * F.when((k + i) % 11 == 0, 0).otherwise(1)
                      for i in range(1, 9)]]
    line = F.concat_ws(";", *[f.cast("string") for f in fields])
    return _events(spark, sf_dir).select(line.alias("value"))


def prototype_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Space-separated lines of the prototype log."""
    k = F.col("k")
    fields = [F.col("uid"), F.lit("-"), F.lit("-"), F.floor(F.col("value") * 60),
              F.to_date("ts"), F.lit("-"), F.concat(F.lit("CH"), k % 20), F.hour("ts")]
    line = F.concat_ws(" ", *[f.cast("string") for f in fields])
    return _events(spark, sf_dir).select(line.alias("value"))


def channel_dictionary(spark: SparkSession) -> DataFrame:
    """Channels 0-14 with one of the two reported types; 15-19 are not listed."""
    i = F.col("id")
    return spark.range(15).select(
        F.concat(F.lit("CH"), i).alias("channel_name"),
        F.when(i < 7, "央视频道").otherwise("卫视频道").alias("channel_type"),
    )


def demand_viewing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand records by day (uid, seconds, day, show_name, week, month, flag).

    The orders are dealt by number: where both tables are sorted, adaptive execution then leaves the
    tasks of the join, which also collect its rows, as many as the session asks for.
    """
    day = F.to_date("o_orderdate")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("uid"), day.alias("day")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.floor(F.col("l_quantity") * 60).alias("seconds"),
        F.col("l_partkey").alias("show_name"),
        (F.col("l_returnflag") == "N").alias("flag"),
    )
    orders = orders.repartition(session_tasks(orders), "o_orderkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "uid", "seconds", "day", "show_name",
        week_key(F.col("day")).alias("week"), month_key(F.col("day")).alias("month"), "flag",
    )


def show_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("show_name"), F.col("p_type").alias("show_type")
    )


PART_TYPES = ("ECONOMY", "PROMO")


def demand_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand records with an hour, of the same month as the live ones."""
    kind = F.col("event_type")
    rows = (
        _events(spark, sf_dir)
        .filter(kind.isin(*REQUESTS))
        .select(
            "uid",
            "ts",
            F.floor(F.col("value") * 60).alias("seconds"),
            F.concat(F.lit("P"), F.col("k")).alias("show_name"),
            (kind == "purchase").alias("flag"),
        )
    )
    return with_calendar_keys(rows).drop("ts")


def hour_show_dictionary(spark: SparkSession) -> DataFrame:
    """Shows P0-P99: films, series, and every third one not listed."""
    i = F.col("id")
    return (
        spark.range(100)
        .filter(i % 3 != 2)
        .select(
            F.concat(F.lit("P"), i).alias("show_name"),
            F.when(i % 3 == 0, "电影").otherwise("电视剧").alias("show_type"),
        )
    )


def base_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users known before the first period: one segment of the customers."""
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "BUILDING")
        .select(F.col("c_custkey").alias("uid"))
    )
