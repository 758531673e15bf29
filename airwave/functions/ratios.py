"""Arithmetic of the KPI columns: sum integers, divide once, as doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPORT_DECIMALS = 4


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as a double; null when the bottom is zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def shown(value: Column) -> Column:
    """Round to the decimals that reports print."""
    return F.round(value, REPORT_DECIMALS)


def minutes(seconds: Column) -> Column:
    return seconds.cast("double") / F.lit(60.0)


def user_index(group_minutes: Column, period_minutes: int, cover: Column, weight: float) -> Column:
    """Minutes per covered user, as a share of the period's length, times a weight."""
    return ratio(group_minutes / F.lit(float(period_minutes)), cover) * F.lit(float(weight))
