"""The time of a user's next or previous event, safe for a user with a huge share of rows.

``lead`` over (user, time) sorts all rows of a user in one task. That is right for almost
everybody, so only the time lines of heavy users are cut, into hours: the window runs per
(user, slot), where the slot is the hour of a heavy user's row and 0 for all other rows.
What lies beyond a heavy user's hour is the first (or last) time of the nearest hour with
rows, a grouped minimum per (user, hour); the window over those grows with the calendar and
not with the data. The rows are shuffled and sorted once, and a later sum per user and hour
needs no further shuffle if it groups by the slot too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airwave.operators.skew import heavy_keys


def with_slots(rows: DataFrame, heavy: DataFrame, by: str = "uid") -> DataFrame:
    """Add ``slot``: the hour of a heavy user's row, 0 for all other rows; and ``_heavy``, null or true."""
    marks = F.broadcast(heavy.select(by, F.lit(True).alias("_heavy")))
    hour = F.floor(F.unix_timestamp("ts") / 3600).cast("int")
    return rows.join(marks, by, "left").withColumn(
        "slot", F.when(F.col("_heavy"), hour).otherwise(0)
    )


def _over_slots(
    cut: DataFrame, name: str, order: list[str], by: str, ahead: bool, also: tuple[str, ...] = ()
) -> DataFrame:
    """``cut`` is what ``with_slots`` gives. With ``also`` the result is a struct of ``ts`` and those."""
    step, edge = (F.lead, F.min) if ahead else (F.lag, F.max)
    key = [by, "slot"]
    what = F.struct("ts", *also) if also else F.col("ts")
    inside = Window.partitionBy(*key).orderBy(*order)
    across = Window.partitionBy(by).orderBy("slot")
    beyond = (
        cut.filter("_heavy")
        .groupBy(*key)
        .agg(edge(what).alias("_edge"))
        .select(*key, step("_edge").over(across).alias("_beyond"))
    )
    near = cut.drop("_heavy").withColumn("_near", step(what).over(inside))
    others = [c for c in cut.columns if c not in ("slot", "_heavy")]
    return near.join(beyond, key, "left").select(
        *others, "slot", F.coalesce("_near", "_beyond").alias(name)
    )


def _with_neighbour(
    rows: DataFrame, name: str, order: list[str], heavy: DataFrame | None, by: str, ahead: bool,
    also: tuple[str, ...] = (),
) -> DataFrame:
    heavy = heavy_keys(rows, by) if heavy is None else heavy
    # Said here because the joins imply it on some branches only, which would keep the
    # shuffles below them from being shared.
    rows = rows.filter(F.col(by).isNotNull())
    return _over_slots(with_slots(rows, heavy, by), name, order, by, ahead, also)


def with_next(
    rows: DataFrame, name: str, order: list[str], heavy: DataFrame | None = None, by: str = "uid",
    also: tuple[str, ...] = (),
) -> DataFrame:
    """Add the ``ts`` of the same user's following row, null on the last, and ``slot``.

    Rows without a user drop out. ``order`` must begin with ``ts`` and be a total order within a user. ``heavy`` lists the
    heavy users, for callers that know them already. Rows are read more than once, so they
    must not depend on chance. ``also`` are columns that follow ``ts`` in ``order``: the result
    is then a struct of both, of the following row.
    """
    return _with_neighbour(rows, name, order, heavy, by, ahead=True, also=also)


def with_next_stored(rows: DataFrame, name: str, order: list[str], by: str = "uid") -> DataFrame:
    """``with_next`` of rows that have their ``slot`` already and are stored by user and slot
    (``sinks/viewers.py``): they are not shuffled again. Only a heavy user's hours are, one row each.
    """
    stored = rows.withColumn("_heavy", F.col("slot") != 0)
    return _over_slots(stored, name, order, by, ahead=True)


def with_previous(
    rows: DataFrame, name: str, order: list[str], heavy: DataFrame | None = None, by: str = "uid"
) -> DataFrame:
    """Add the ``ts`` of the same user's preceding row, null on the first, and ``slot``."""
    return _with_neighbour(rows, name, order, heavy, by, ahead=False)
