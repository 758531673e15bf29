"""Text clean-up of log fields, and the text form of report rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "?"


def known_or_mark(name: Column) -> Column:
    """An empty or ``null`` name becomes the unknown mark; the result is never null."""
    return F.coalesce(F.when(~name.isin("", "null"), name), F.lit(UNKNOWN))


def clean_channel(name: Column) -> Column:
    """Channel without its bracketed note, as in ``News(pay)``."""
    return F.substring_index(known_or_mark(name), "(", 1)


def log_time(text: Column) -> Column:
    """``yyyyMMddHHmmss`` as a time without zone; null if it is not one."""
    cuts = [(1, 4, "-"), (5, 2, "-"), (7, 2, " "), (9, 2, ":"), (11, 2, ":"), (13, 2, "")]
    parts = [part for at, n, mark in cuts for part in (F.substring(text, at, n), F.lit(mark))]
    digits = (F.length(text) == 14) & (F.translate(text, "0123456789", "") == "")
    return F.when(digits, F.concat(*parts[:-1]).try_cast("timestamp_ntz"))


def time_text(ts: Column) -> Column:
    """The 14-character form of a time."""
    return F.translate(F.substring(ts.cast("string"), 1, 19), "- :", "")


def tail_digits(uid: Column, n: int = 6) -> Column:
    """The last ``n`` digits of a user id as a number; ids differ in length."""
    return F.right(uid.cast("string"), F.lit(n)).try_cast("long")


def tsv_lines(df: DataFrame, decimals: int = 4) -> DataFrame:
    """One tab-separated ``value`` per row: fixed decimals, ``null`` for a missing field."""
    fields = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType.typeName()
        if kind in ("double", "float", "decimal"):
            number = F.format_string(f"%.{decimals}f", column.cast("double"))
            column = F.when(column.isNotNull(), number)
        elif kind == "timestamp_ntz":
            column = time_text(column)
        fields.append(F.coalesce(column.cast("string"), F.lit("null")))
    return df.select(F.concat_ws("\t", *fields).alias("value"))
