"""Tab-separated records that the jobs exchange, and their typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.sources.logs import read_lines

STREAM = (("uid", "string"), ("time_text", "string"),
          ("channel_name", "string"), ("program_name", "string"))

LIVE_VIEWING = (("uid", "string"), ("month", "int"), ("week", "int"), ("day", "date"),
                ("hour", "int"), ("channel_name", "string"), ("program_name", "string"),
                ("seconds", "long"))

DEMAND_VIEWING = (("uid", "string"), ("seconds", "long"), ("day", "date"),
                  ("show_name", "string"), ("hour", "int"), ("week", "int"),
                  ("month", "int"), ("flag", "boolean"))

LIVE_SUMMARY = (("grain", "string"), ("period", "string"), ("user_num", "long"),
                ("cover_user_num", "long"), ("user_in_num", "long"),
                ("user_out_num", "long"), ("last_user_num", "long"),
                ("time_in_use", "double"))

DEMAND_SUMMARY = LIVE_SUMMARY[:7] + (("request_times", "long"), ("time_in_use", "double"),
                                     ("all_show_num", "long"))

# Columns 4 and up of the hour report are not needed by its readers.
HOUR_SUMMARY = (("day", "date"), ("hour", "int"), ("user_type", "int"),
                ("user_num", "long"), ("cover_pct", "double"), ("time_in_use", "double"))

CHANNEL_DICT = (("channel_name", "string"), ("channel_type", "string"))
SHOW_DICT = (("show_name", "string"), ("show_type", "string"))
UIDS = (("uid", "string"),)

# Space-separated prototype log: wanted positions only.
PROTOTYPE = {"uid": (0, "string"), "remain_time": (3, "double"), "date": (4, "string"),
             "channel_name": (6, "string"), "time_frame": (7, "int")}

# Numbers that a written line may lack: ratios without a summary row.
OPTIONAL = ("cover_pct",)

KEY_TYPE = {"day": "date", "week": "int", "month": "int"}


def parse_records(lines: DataFrame, layout, separator: str = "\t") -> DataFrame:
    """Typed columns of separated lines.

    A line is dropped if it is blank, cut short, or without its first field or any number or
    date of the layout (OPTIONAL ones may be missing); ``dropped_lines`` counts those. Text
    fields may be empty. As in ``parse_raw_log``, a line is split once.
    """
    fields = F.split(F.col("value"), separator)
    typed = [
        F.get("f", F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(layout)
    ]
    split = lines.filter(F.col("value") != "").select(F.explode(F.array(fields)).alias("f"))
    whole = split.filter(F.size("f") >= len(layout))
    return whole.select(*typed).dropna(subset=_required(layout))


def _required(layout) -> list[str]:
    """Columns that a line can't be without: the first, and all that aren't text or optional."""
    rest = [name for name, kind in layout[1:] if kind != "string" and name not in OPTIONAL]
    return [layout[0][0], *rest]


def dropped_lines(lines: DataFrame, layout, separator: str = "\t") -> int:
    """How many lines that aren't blank ``parse_records`` drops."""
    return lines.filter(F.col("value") != "").count() - parse_records(lines, layout, separator).count()


def parse_prototype(lines: DataFrame) -> DataFrame:
    """Columns of the space-separated prototype log; lines with an unreadable field are dropped.

    As in ``parse_records``, a line is split once.
    """
    fields = F.explode(F.array(F.split("value", " "))).alias("f")
    split = lines.filter(F.col("value") != "").select(fields)
    return split.select(
        *[F.get("f", F.lit(i)).try_cast(kind).alias(n) for n, (i, kind) in PROTOTYPE.items()]
    ).dropna()


def read_records(spark: SparkSession, path: str, layout) -> DataFrame:
    return parse_records(read_lines(spark, path), layout)


def summary_of(summaries: DataFrame, grain: str) -> DataFrame:
    """Rows of one grain with the period as that grain's typed key.

    Over Parquet written with ``partitionBy("grain")`` the filter prunes directories.
    """
    rows = summaries.filter(F.col("grain") == grain)
    key = F.col("period").cast(KEY_TYPE[grain]).alias(grain)
    return rows.select(key, *[c for c in summaries.columns if c not in ("grain", "period")])


def unique_dictionary(dictionary: DataFrame) -> DataFrame:
    """One type per name, the least one, so that a lookup never multiplies rows."""
    name, kind = dictionary.columns[:2]
    return dictionary.groupBy(name).agg(F.min(kind).alias(kind))
