"""Keys with a huge share of the rows, and a dictionary lookup that they do not slow down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_ROWS = 1_000_000
MOST_HEAVY = 50_000
#: Parts that the rows of one name are dealt to.
NAME_PARTS = 8


def heavy_keys(rows: DataFrame, by: str = "uid", limit: int = HEAVY_ROWS) -> DataFrame:
    """Keys with more than ``limit`` rows and more than 1/50,000 of all rows.

    So there are fewer than 50,000 of them at any scale, which makes the list safe to
    broadcast. The counts are partial sums before the shuffle, and their sum reads that shuffle.
    """
    counts = rows.groupBy(by).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.filter((F.col("_n") > limit) & (F.col("_n") * MOST_HEAVY > total)).select(by)


def session_tasks(rows: DataFrame) -> int:
    """The session's ``spark.sql.shuffle.partitions``: a number of tasks that, asked for by name, adaptive
    execution does not merge by compressed size."""
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def lookup(
    rows: DataFrame, unique: DataFrame, how: str = "inner", spread: str | None = "uid", *, tasks: int | None = None
) -> DataFrame:
    """Add the type of each row's name from a dictionary with one row per name.

    One plan at every size: a hash of ``spread`` deals the rows of a name to NAME_PARTS parts,
    and each entry meets all of them, so that a name with a large share of the rows is not one
    task. Whether the entries are broadcast is left to adaptive execution. Without ``spread``
    (rows of which no name has many) it is a plain join.

    A dictionary that grows with the data takes ``tasks``: both sides are then dealt to that many, so
    that adaptive execution sees all NAME_PARTS copies of the entries before it broadcasts them (a plan
    made from the size of the files does not) and can join without a shuffle more.
    """
    name = unique.columns[0]
    if spread is None:
        return rows.join(unique, name, how)
    parts = F.explode(F.sequence(F.lit(0), F.lit(NAME_PARTS - 1)))
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(spread), F.lit(NAME_PARTS)).cast("int"))
    entries = unique.withColumn("_part", parts)
    if tasks is not None:
        dealt, entries = (side.repartition(tasks, name, "_part") for side in (dealt, entries))
    return dealt.join(entries, [name, "_part"], how).drop("_part")
