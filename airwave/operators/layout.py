"""Placement and order of rows for files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.functions.text import tail_digits


def viewer_slot(uid: Column, n: int) -> Column:
    """Slot of a viewer: the last six digits modulo ``n``."""
    return F.pmod(F.coalesce(tail_digits(uid), F.lit(0)), F.lit(n)).cast("int")


def partition_by_viewer(
    rows: DataFrame, n: int, sort: tuple[str, ...] = (), spread: int = 1
) -> DataFrame:
    """Place each viewer's rows in the partition of the viewer's slot, sorted if asked.

    With ``spread`` > 1 each slot takes that many partitions in a row (slot ``s`` owns
    ``s * spread`` up to ``s * spread + spread - 1``) and a viewer's rows are dealt over
    them by all other columns, so a viewer with a huge share of the rows does not end in
    one task.
    """
    place = viewer_slot(F.col("uid"), n)
    if spread > 1:
        others = [c for c in rows.columns if c != "uid"]
        place = place * spread + F.pmod(F.xxhash64(*others), F.lit(spread)).cast("int")
    placed = rows.repartitionById(n * spread, place)
    return placed.sortWithinPartitions(*sort) if sort else placed


def sorted_for_files(rows: DataFrame, keys: list[str], files: int = 0) -> DataFrame:
    """Rows in one global order over range partitions, sorted inside each.

    All of ``keys`` take part in the ranges, so one user's rows can span partitions.
    """
    ranges = [files, *keys] if files else keys
    return rows.repartitionByRange(*ranges).sortWithinPartitions(*keys)
