"""Shards of nearly equal bytes, by sampled splitters.

Every record gets a sortable key. A size-weighted sample of keys gives quantile boundaries, which
cut the key space into many fine ranges; ranges that turn out overfull are subdivided by a sample
of their own. Exact sizes and counts of the ranges and a running sum inside each of them then
place every record on one line from 0 to all bytes, which is cut into equal shards.

The key is a hash of the text, then of the id: equal texts lie side by side and share a shard
unless they are so many that they'd make it uneven; such a hot group spreads over many ranges.

Defined cases: a null text has size 1, an empty text too; a null id is a value like others; rows
repeated in all columns get a place each; an empty table gives no rows; columns of other names
are kept by ``shard``, whose own helpers begin with ``_shard``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Low bits of a key, which part records with equal texts.
SALT_BITS = 24
RANGE_ROWS = 100_000
SAMPLES_PER_RANGE = 30
#: Splitters are kept in the tasks: at most 8 MB.
MOST_RANGES = 1 << 20
#: A group of equal texts over this share of a shard may be parted.
WHOLE_GROUP = 0.02


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def record_key(text: Column, doc_id: Column) -> Column:
    """High bits of a hash of the text, then low bits of a hash of the id."""
    high = F.shiftleft(F.shiftright(F.xxhash64(text), SALT_BITS), SALT_BITS)
    return high.bitwiseOR(F.xxhash64(doc_id).bitwiseAND((1 << SALT_BITS) - 1))


def _range_of(splitters: np.ndarray):
    @F.pandas_udf("int")
    def find(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, key.to_numpy(), "right").astype(np.int32))

    return find


def _quantiles(sample: pd.DataFrame, parts: int) -> np.ndarray:
    """Boundaries between ``parts`` ranges of about equal weight."""
    sample = sample.sort_values("key")
    weight = sample["weight"].cumsum().to_numpy()
    if not len(weight):
        return np.zeros(0, np.int64)
    at = np.searchsorted(weight, weight[-1] * np.arange(1, parts) / parts)
    return np.unique(sample["key"].to_numpy(np.int64)[at])


def _sample(rows: DataFrame, rate: Column, seed: int) -> pd.DataFrame:
    """Rows drawn in proportion to their size; one drawn with certainty counts its whole size."""
    rate = F.least(rate * F.col("size"), F.lit(1.0))
    draw = (F.xxhash64("key", F.lit(seed)).bitwiseAND((1 << 40) - 1)) / F.lit(float(1 << 40))
    drawn = rows.withColumn("_p", rate).where(draw < F.col("_p"))
    return drawn.select("key", (F.col("size") / F.col("_p")).alias("weight")).toPandas()


def splitters(rows: DataFrame, ranges: int, rounds: int = 3) -> tuple[np.ndarray, pd.DataFrame]:
    """Boundaries of the fine ranges of (key, size) rows, and each range's exact bytes and rows.

    What comes to the driver is the sample (about SAMPLES_PER_RANGE keys a range) and one row for
    each range. A range with over twice its share of bytes is subdivided, unless it is one key.
    """

    def sizes(bounds: np.ndarray) -> pd.DataFrame:
        cut = rows.groupBy(_range_of(bounds)("key").alias("part"))
        return cut.agg(
            F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        ).toPandas().sort_values("part", ignore_index=True)

    total = rows.agg(F.sum("size")).first()[0] or 0
    share = max(1.0, total / ranges)
    bounds = _quantiles(_sample(rows, F.lit(SAMPLES_PER_RANGE / share), 0), ranges)
    for turn in range(rounds):
        found = sizes(bounds)
        over = found[(found["bytes"] > 2 * share) & (found["low"] < found["high"])]
        if over.empty:
            return bounds, found
        parts = over["part"].to_numpy()
        inside = rows.where(_range_of(bounds)("key").isin(parts.tolist()))
        drawn = _sample(inside, F.lit(2 * SAMPLES_PER_RANGE / share), turn + 1)
        part = np.searchsorted(bounds, drawn["key"].to_numpy(np.int64), "right")
        more = [
            _quantiles(drawn[part == p], int(np.ceil(b / share)) + 1)
            for p, b in zip(parts, over["bytes"], strict=True)
        ]
        bounds = np.unique(np.concatenate([bounds, *more]))
    return bounds, sizes(bounds)


def shard(rows: DataFrame, shards: int = 16, ranges: int | None = None) -> DataFrame:
    """Rows with ``key`` and ``size`` (and any others), plus ``shard`` and ``slot``.

    ``slot`` counts from 0 in each shard, in the order of keys. ``rows`` is read several times, so
    give it narrow and saved.
    """
    n = rows.count()
    ranges = ranges or int(min(MOST_RANGES, max(8 * shards, n // RANGE_ROWS)))
    bounds, found = splitters(rows, ranges)
    before = found[["part"]].assign(
        _shard_bytes=found["bytes"].cumsum() - found["bytes"], _shard_rows=found["n"].cumsum() - found["n"]
    )
    spark, total = rows.sparkSession, int(found["bytes"].sum())
    starts = spark.createDataFrame(before.astype("int64"), "part long, _shard_bytes long, _shard_rows long")
    placed = rows.withColumn("_shard_part", _range_of(bounds)("key").cast("long")).join(
        F.broadcast(starts.withColumnRenamed("part", "_shard_part")), "_shard_part"
    )
    group = F.shiftright("key", SALT_BITS)
    ties = [c for c in rows.columns if c not in ("key", "size")]
    inside = Window.partitionBy("_shard_part").orderBy("key", "size", *ties)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = (
        placed.withColumn("_shard_end", F.col("_shard_bytes") + F.sum("size").over(so_far))
        .withColumn("_shard_row", F.col("_shard_rows") + F.row_number().over(inside) - 1)
        .withColumn("_shard_group", group)
    )
    # a group of equal texts inside one range goes by its middle, a larger one by its rows' middles
    own = Window.partitionBy("_shard_part", "_shard_group")
    first = F.min(F.col("_shard_end") - F.col("size")).over(own)
    last = F.max("_shard_end").over(own)
    small = (last - first) <= F.lit(WHOLE_GROUP * total / shards)
    middle = F.when(small, (first + last) / 2).otherwise(F.col("_shard_end") - F.col("size") / 2)
    line = line.withColumn("shard", F.least(F.floor(middle * shards / F.lit(float(max(total, 1)))), F.lit(shards - 1)).cast("int"))
    # a shard's first row, from each range's first: one row for each range and shard
    firsts = line.groupBy("shard").agg(F.min("_shard_row").alias("_shard_first"))
    line = line.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("_shard_row") - F.col("_shard_first"))
    return line.select(*rows.columns, "shard", "slot")
