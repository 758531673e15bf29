"""Viewing measured batch by batch, equal to the viewing of the whole log.

A batch holds the records of one stretch of time, later than those of all batches before. What
a batch cannot settle goes along to the next one, at most three rows a user:

- the last power record: the next switch-on tells whether the box went off after it;
- the last live record, whose end is not known yet;
- the live record before the moment at which the box went off if the next power record is a
  switch-on. That moment follows from the last power record alone, so it is known, and it may
  lie before live records of the same batch; ``until`` is when the record ends otherwise.

All other records of a batch are final, since what a later batch can add is that one moment or
later than the batch. Records of one user at the same second belong to one batch; records of a
user who never comes back stay in the state.

Empty batches and users without live or power records are fine. Rows without a user drop out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airwave.operators.neighbours import with_next
from airwave.operators.skew import heavy_keys
from airwave.operators.viewing import off_time, shutdown_times, within_bounds

#: Kinds of a line: a record with its end, one without, and the moment of a possible shutdown.
DONE, OPEN, MARK = "done", "open", "mark"
# Order of events at the same second.
LIVE, MAYBE, SHUT = 0, 1, 2


@dataclass(frozen=True)
class State:
    """What goes along: live records with ``until``, and the last power record of each user."""

    live: DataFrame
    power: DataFrame


def last_power(power: DataFrame, state: State | None = None, tie: list[str] | None = None) -> DataFrame:
    """The last power record of each user, this batch's or the one from before."""
    columns = ["ts", "opens", *(tie or [])]
    rows = power if state is None else power.unionByName(state.power)
    last = rows.filter(F.col("uid").isNotNull()).groupBy("uid").agg(F.max(F.struct(*columns)).alias("last"))
    return last.select("uid", *[F.col(f"last.{c}").alias(c) for c in columns])


def lines(
    live: DataFrame,
    power: DataFrame,
    state: State | None = None,
    tie: list[str] | None = None,
    draw: int | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Live records of the batch and the state with their ``kind`` and, where it is known, ``next_ts``.

    Takes the same columns as ``viewing.dwell_times`` and ``viewing.shutdown_times``. Marks are for
    ``carried``. Save the result before both of ``settled`` and ``carried`` read it.
    """
    order_tie = tie or ["channel_name", "program_name"]
    never = F.lit(None).cast("timestamp_ntz")
    rows = live.withColumn("until", never)
    powers = power.select("uid", "ts", "opens", *(tie or []))
    if state is not None:
        rows = rows.unionByName(state.live)
        powers = powers.unionByName(state.power)
    if heavy is None:
        heavy = heavy_keys(rows.select("uid").unionByName(powers.select("uid")))

    shut = shutdown_times(powers, tie, draw, heavy).withColumn("off", F.lit(SHUT))
    maybe = last_power(power, state, tie).select(
        "uid", off_time(F.col("ts"), draw).alias("ts"), *(tie or []), F.lit(MAYBE).alias("off")
    )
    stream = (
        rows.withColumn("off", F.lit(LIVE))
        .unionByName(shut, allowMissingColumns=True)
        .unionByName(maybe, allowMissingColumns=True)
    )
    following = with_next(stream, "following", ["ts", "off", *order_tie], heavy, also=("off",))

    after = F.col("following.ts")
    unsure = (F.col("following.off") == MAYBE) & (F.col("until").isNull() | (after < F.col("until")))
    end = F.when(F.coalesce(unsure, F.lit(False)), None).otherwise(F.least("until", after))
    kind = (
        F.when(F.col("off") == MAYBE, MARK).when(F.col("next_ts").isNull(), OPEN).otherwise(DONE)
    )
    return (
        following.filter(F.col("off") != SHUT)
        .withColumn("next_ts", F.when(F.col("off") == MAYBE, after).otherwise(end))
        .withColumn("unsure", F.coalesce(unsure, F.lit(False)) & (F.col("off") == LIVE))
        .withColumn("kind", kind)
        .drop("off", "following")
    )


def settled(marked: DataFrame) -> DataFrame:
    """Viewing of the records whose end is known, as ``viewing.dwell_times`` gives it."""
    done = marked.filter(F.col("kind") == DONE)
    return within_bounds(done.drop("kind", "unsure", "until"))


def carried(marked: DataFrame) -> DataFrame:
    """The live records that go along: at most two a user, so the window has three rows at most."""
    later = F.max(F.when(F.col("kind") == MARK, F.col("next_ts"))).over(Window.partitionBy("uid"))
    still = marked.filter(F.col("kind") != DONE).withColumn("later", later)
    until = F.when(F.col("unsure"), F.least("until", "later"))
    return (
        still.filter(F.col("kind") == OPEN)
        .withColumn("until", until)
        .drop("kind", "unsure", "next_ts", "later", "slot")
    )


def rest(state: State) -> DataFrame:
    """Viewing of the records that no further batch will settle, with the columns of ``settled``."""
    ended = state.live.filter(F.col("until").isNotNull()).withColumnRenamed("until", "next_ts")
    return within_bounds(ended.withColumn("slot", F.lit(0)))
