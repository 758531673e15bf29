"""A report's groups and its period totals from one aggregate.

Every row stands for several levels at once: its user in the period (totals and flows), its user in
the group (channel, show or type), its item in the period and in the group. A level tag is one of the
grouping keys, as in grouping sets, so that one shuffle sums all of them and the facts are read once,
whatever the optimizer does to the readers of a shared plan. Totals then come beside the groups by a
window over the few rows of a period: one for each group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airwave.functions.calendar import DAY, HOUR, Grain, dense_calendar, period_key, period_start, shift_period, start_of_key
from airwave.functions.ratios import minutes
from airwave.operators import kpi
from airwave.operators.flows import ACTIVE, KNOWN, PREVIOUS, bounds, flow_marks
from airwave.operators.skew import lookup, session_tasks

#: Levels: a user of the period, a user of a group, an item of the period, an item of a group.
USER, MEMBER, ITEM, GROUP_ITEM = range(4)
_OF_GROUP = ["group_users", "group_seconds", "group_items"]


def _level(level: int, group: Column, uid: Column, item: Column, seconds: Column, requests: Column) -> Column:
    return F.struct(
        F.lit(level).alias("level"), group.alias("group"), uid.alias("uid"), item.alias("item"),
        seconds.alias("seconds"), requests.alias("requests"),
    )


def _sums(rows: DataFrame, group: str, item: str | None) -> DataFrame:
    """One row per (level, period, group, user or item) from rows (period, uid, seconds, n,
    n_flagged, the group's and the item's column); rows without a group count for totals alone.

    The rows are dealt first, by all their columns and into as many tasks as the session's
    ``spark.sql.shuffle.partitions``: a task keeps a group for nearly every level of its rows, far more
    than their compressed size tells adaptive execution, which would merge tasks by that size.
    """
    tasks = session_tasks(rows)
    rows = rows.select("period", "uid", "seconds", "n", "n_flagged", group, *([item] if item else []))
    rows = rows.repartition(tasks, *rows.columns)
    named, zero = F.col(group), F.lit(0).cast("long")
    no_group, no_uid = (F.lit(None).cast(rows.schema[c].dataType) for c in (group, "uid"))
    no_item = F.lit(None).cast(rows.schema[item].dataType if item else "string")
    uid, seconds = F.col("uid"), F.col("seconds").cast("long")
    made = [
        _level(USER, no_group, uid, no_item, seconds * F.col("n"), F.col("n_flagged")),
        F.when(named.isNotNull(), _level(MEMBER, named, uid, no_item, seconds, zero)),
    ]
    if item:
        made.append(F.when(F.col(item).isNotNull(), _level(ITEM, no_group, no_uid, F.col(item), zero, zero)))
        made.append(F.when(named.isNotNull(), _level(GROUP_ITEM, named, no_uid, F.col(item), zero, zero)))
    each = rows.select("period", F.explode(F.array_compact(F.array(*made))).alias("l"))
    keys = ["level", "period", "group", "uid", "item"]
    return each.select("period", "l.*").groupBy(*keys).agg(F.sum("seconds").alias("seconds"), F.sum("requests").alias("requests"))


def _one(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("long")


def _part(parts: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int")


def grouped_with_totals(
    requests: DataFrame,
    grain: Grain,
    first,
    last,
    group: str,
    *,
    item: str | None = None,
    seed_cover: DataFrame | None = None,
) -> DataFrame:
    """Groups per period (group_users, group_seconds and, with ``item``, group_items), each beside its
    period's user_num, cover_user_num, time_in_use (and all_show_num).

    ``requests`` are rows as of ``kpi.counted_requests`` with their own period keys. Totals are as of
    ``flows.period_summary`` with ``own_key`` and ``look_back``: users of the period just before the
    first one are not reached by that. ``seed_cover`` are users reached before.
    """
    start, end = bounds(grain, first, last)
    before, long_before = shift_period(grain, start, -1), shift_period(grain, start, -2)
    period = F.col("period")
    rows = requests.withColumn("period", start_of_key(grain, F.col(grain.name)))
    sums = _sums(rows.filter(period.between(before, end)), group, item)
    states = sums.withColumn("role", F.when(period < start, PREVIOUS).otherwise(ACTIVE))
    if seed_cover is not None:
        # One period earlier still, where it cannot be taken for the previous period.
        known = seed_cover.select("uid").distinct().select(
            F.lit(USER).alias("level"), long_before.alias("period"), "uid",
            F.lit(0).cast("long").alias("seconds"), F.lit(0).cast("long").alias("requests"), F.lit(KNOWN).alias("role"),
        )
        states = states.unionByName(known, allowMissingColumns=True)

    # Dealt by number from here on, evenly: no task holds all lines of a group or all rows of a period.
    tasks = session_tasks(requests)
    states = states.withColumn("part", _part(tasks, "level", "uid", "group", "item")).repartitionById(tasks, "part")

    # A user's periods are one line; every other level's lines are as short as the calendar too.
    line = Window.partitionBy("part", "level", "uid", "group", "item").orderBy("period")
    marks = flow_marks(grain, line)
    level, zero = F.col("level"), F.lit(0).cast("long")
    user, active = level == USER, F.col("role") == ACTIVE
    # A row counts for its period's total or for its group, never for both.
    counted = states.select(
        "part",
        "period",
        "group",
        user | (level == ITEM),
        F.when(user, marks["users"]).otherwise(_one((level == MEMBER) & active)),
        F.when(user, marks["reached"]).otherwise(zero),
        F.when(level.isin(USER, MEMBER) & active, F.col("seconds")).otherwise(zero),
        _one(level.isin(ITEM, GROUP_ITEM) & active),
    )
    names = ["users", "reached", "seconds", "shows"]
    counted = counted.toDF("part", "period", "group", "total", *names)
    sums = [F.sum(n).alias(n) for n in names]
    # A task's own sums first: of a total, or of a large group, each task hands on one row a period.
    counted = counted.groupBy("part", "total", "period", "group").agg(*sums).drop("part")
    empty = dense_calendar(requests.sparkSession, grain, long_before, end).select(
        "period", F.lit(True).alias("total"), *[zero.alias(n) for n in names]
    )
    counts = (
        counted.unionByName(empty, allowMissingColumns=True)
        .repartition(tasks, "total", "group")
        .groupBy("total", "period", "group")
        .agg(*sums)
    )
    # From here on there is one row per period and group, and one per period for the totals, which goes
    # to every part of the period's groups.
    run = Window.partitionBy("total", "group").orderBy("period")
    every, own = F.sequence(F.lit(0), F.lit(tasks - 1)), F.array(_part(tasks, "period", "group"))
    out = (
        counts.withColumn("cover", F.sum("reached").over(run))
        .withColumn("part", F.explode(F.when(F.col("total"), every).otherwise(own)))
        .repartitionById(tasks, "part")
    )
    total = F.when(F.col("total"), F.struct("users", "cover", "seconds", "shows"))
    out = out.withColumn("t", F.max(total).over(Window.partitionBy("part", "period")))
    of_group = {"users": "group_users", "seconds": "group_seconds", **({"shows": "group_items"} if item else {})}
    return out.filter(~F.col("total") & (period >= start)).select(
        period_key(grain, period).alias(grain.name),
        F.col("group").alias(group),
        *[F.col(n).alias(name) for n, name in of_group.items()],
        F.col("t.users").alias("user_num"),
        F.col("t.cover").alias("cover_user_num"),
        minutes(F.col("t.seconds")).alias("time_in_use"),
        *([F.col("t.shows").alias("all_show_num")] if item else []),
    )


def type_report(requests, dictionary, grain, first, last, business, *, kinds=None, weight=kpi.WEIGHT, seed_cover=None) -> DataFrame:
    """KPIs per period and type, as of ``kpi.type_report``, from one aggregate."""
    known = kpi.reported(dictionary, business, kinds)
    typed = lookup(requests, known, "left", tasks=session_tasks(requests))
    groups = grouped_with_totals(typed, grain, first, last, business.kind, item=business.item, seed_cover=seed_cover)
    return kpi.with_totals(groups, grain, business, [business.kind], business.prefix, weight)


def item_report(requests, dictionary, grain, first, last, business, *, kinds=None, weight=kpi.WEIGHT, seed_cover=None) -> DataFrame:
    """KPIs per period and show, as of ``kpi.item_report``, from one aggregate; the dictionary joins the
    grouped rows."""
    groups = grouped_with_totals(requests, grain, first, last, business.item, seed_cover=seed_cover)
    known = groups.join(kpi.reported(dictionary, business, kinds), business.item)
    return kpi.with_totals(known, grain, business, [business.item, business.kind], business.prefix, weight)


# --- hours ------------------------------------------------------------------------------------

#: One more level: a user of the day, for the users reached by it.
DAY_USER = 4


def live_pieces(viewing: DataFrame) -> DataFrame:
    """Adds ``pieces``: the hours a record covers, as ``viewing.split_hours`` cuts them."""
    steps = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("seconds") / 3600), F.lit(1)).cast("int") - 1)

    def piece(i: Column) -> Column:
        hour = F.col("hour") + i
        return F.struct(
            F.date_add("day", F.floor(hour / 24).cast("int")).alias("day"),
            (hour % 24).cast("int").alias("hour"),
            F.least(F.lit(3600), F.col("seconds") - 3600 * i).cast("long").alias("seconds"),
        )

    return viewing.withColumn("pieces", F.transform(steps, piece))


def request_piece(requests: DataFrame) -> DataFrame:
    """Adds ``pieces``: a request lies in its hour alone."""
    one = F.struct("day", "hour", F.col("seconds").cast("long").alias("seconds"))
    return requests.withColumn("pieces", F.array(one))


def hours_with_totals(rows: DataFrame, first, last, groups: list[str], *, item: str | None = None, flag: str | None = None) -> DataFrame:
    """Groups per hour (group_users, group_seconds and, with ``item``, group_items) beside the totals of
    the hour: user_num, time_in_use, cover_user_num (users reached by the day, null after ``last``),
    requests (rows with the ``flag``) and, with ``item``, all_show_num. Without ``groups`` the totals alone.

    ``rows`` have uid, day (the one that counts for reaching the user), ``pieces`` and the columns named.
    """
    zero, uid = F.lit(0).cast("long"), F.col("uid")
    group = F.struct(*groups) if groups else F.lit(None).cast("string")
    known = reduce(lambda a, b: a & b, [F.col(g).isNotNull() for g in groups], F.lit(bool(groups)))
    kinds = {
        "group": "struct<" + ",".join(f"{g}:{rows.schema[g].dataType.simpleString()}" for g in groups) + ">" if groups else "string",
        "uid": rows.schema["uid"].dataType.simpleString(),
        "item": rows.schema[item].dataType.simpleString() if item else "string",
    }
    none = {name: F.lit(None).cast(kind) for name, kind in kinds.items()}
    flagged = F.when(F.col(flag), 1).otherwise(0).cast("long") if flag else zero

    def level(number: int, day: Column, hour: Column, seconds: Column = zero, requests: Column = zero, **keys: Column) -> Column:
        named = [keys.get(name, none[name]).cast(kind).alias(name) for name, kind in kinds.items()]
        return F.struct(F.lit(number).alias("level"), day.alias("day"), hour.alias("hour"), *named, seconds.alias("seconds"), requests.alias("requests"))

    def of_piece(p: Column) -> Column:
        at = (p["day"], p["hour"])
        made = [level(USER, *at, p["seconds"], flagged, uid=uid)]
        if groups:
            made.append(F.when(known, level(MEMBER, *at, p["seconds"], uid=uid, group=group)))
        if item:
            made.append(F.when(F.col(item).isNotNull(), level(ITEM, *at, item=F.col(item))))
            made.append(F.when(known, level(GROUP_ITEM, *at, item=F.col(item), group=group)))
        return F.array(*made)

    day_user = F.array(level(DAY_USER, F.col("day"), F.lit(None).cast("int"), uid=uid))
    every = F.array_compact(F.concat(day_user, F.flatten(F.transform("pieces", of_piece))))
    keys = ["level", "day", "hour", "group", "uid", "item"]
    sums = rows.select(F.explode(every).alias("l")).select("l.*").groupBy(*keys).agg(F.sum("seconds").alias("seconds"), F.sum("requests").alias("requests"))

    # A user's first day: of DAY_USER rows, as many as the calendar has days; other lines are no longer.
    line = Window.partitionBy("level", "uid", "group", "item", "hour").orderBy("day")
    number = F.col("level")
    counts = sums.select(
        "day", "hour", "group", number.isin(USER, ITEM, DAY_USER).alias("total"),
        _one((number == DAY_USER) & (F.row_number().over(line) == 1)).alias("reached"),
        _one(number == USER).alias("users"),
        F.when(number == USER, F.col("seconds")).otherwise(zero).alias("seconds"),
        F.when(number == USER, F.col("requests")).otherwise(zero).alias("requests"),
        _one(number == ITEM).alias("shows"),
        _one(number == MEMBER).alias("group_users"),
        F.when(number == MEMBER, F.col("seconds")).otherwise(zero).alias("group_seconds"),
        _one(number == GROUP_ITEM).alias("group_items"),
    )
    names = ["reached", "users", "seconds", "requests", "shows", *_OF_GROUP]
    # One row per hour and group from here on. Reaching counts on rows without an hour, one for each day
    # of the calendar: a day on which nobody was new has the cover of the day before.
    empty = dense_calendar(rows.sparkSession, DAY, *bounds(DAY, first, last)).select(
        F.lit(True).alias("total"), F.col("period").alias("day"), *[zero.alias(n) for n in names]
    )
    counts = counts.unionByName(empty, allowMissingColumns=True)
    counts = counts.groupBy("total", "day", "hour", "group").agg(*[F.sum(n).alias(n) for n in names])
    of_day = F.col("total") & F.col("hour").isNull()
    run = Window.partitionBy("total", F.col("hour").isNull(), "group").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = counts.withColumn("so_far", F.when(of_day, F.sum("reached").over(run)))
    days = days.withColumn("cover", F.max("so_far").over(Window.partitionBy("day")))
    whole = F.when(F.col("total") & F.col("hour").isNotNull(), F.struct("users", "seconds", "requests", "shows"))
    out = days.withColumn("t", F.max(whole).over(Window.partitionBy("day", "hour")))
    wanted = ~F.col("total") if groups else F.col("total")
    kept = ["group_users", "group_seconds", *(["group_items"] if item else [])] if groups else []
    return out.filter(wanted & F.col("hour").isNotNull()).select(
        "day", "hour", *[F.col("group")[g].alias(g) for g in groups], *kept,
        F.col("t.users").alias("user_num"),
        minutes(F.col("t.seconds")).alias("time_in_use"),
        F.col("cover").alias("cover_user_num"),
        F.col("t.requests").alias("requests"),
        *([F.col("t.shows").alias("all_show_num")] if item else []),
    )


def hour_summary(rows: DataFrame, first, last, business) -> DataFrame:
    """User overview of each hour, as of ``kpi.hour_summary_report``, from one aggregate."""
    flag = "flag" if business is kpi.DEMAND else None
    return kpi.hour_summary_shown(hours_with_totals(rows, first, last, [], flag=flag), business)


def hour_type_report(rows: DataFrame, dictionary: DataFrame, first, last, business, *, weight: float = kpi.WEIGHT) -> DataFrame:
    """KPIs per hour and type, as of ``kpi.type_report``, from one aggregate."""
    typed = lookup(rows, kpi.reported(dictionary, business, None), "left")
    item = business.item if business is kpi.DEMAND else None
    groups = hours_with_totals(typed, first, last, [business.kind], item=item)
    return kpi.with_totals(groups, HOUR, business, [business.kind], business.prefix, weight)


def hour_item_report(
    rows: DataFrame, dictionary: DataFrame, first, last, business, *, programs: bool = False, weight: float = kpi.WEIGHT
) -> DataFrame:
    """KPIs per hour and channel or show, with ``programs`` per channel and program, as of
    ``kpi.item_report``, from one aggregate; the dictionary joins the grouped rows."""
    groups = hours_with_totals(rows, first, last, [business.item, *(["program_name"] if programs else [])])
    known = groups.join(kpi.reported(dictionary, business, None), business.item)
    names, prefix = [business.item, business.kind], business.prefix
    if programs:
        names, prefix = [F.col("program_name").alias("show_name"), *names], "show"
    return kpi.with_totals(known, HOUR, business, names, prefix, weight)
