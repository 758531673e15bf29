"""What the operators share: reading tables, cutting lineage, texts as byte arrays."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task turns into arrays at once.
SLICE_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch on its way to a task's Python worker: whole texts go out, and some come back.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_BYTES at most, unless the session says otherwise.

    Spark's own bound, 64 MB, is held by each task several times: in the JVM, in the worker and, where
    texts are returned, on the way back.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of our own only where that is unset, as in tests."""
    small_batches(spark)
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder is None:
        folder = "file://" + tempfile.mkdtemp(prefix="checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def saved(rows: DataFrame) -> DataFrame:
    """The rows, computed once and written to the shared folder; what follows reads them there."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def compact(rows: DataFrame, per_part: int) -> DataFrame:
    """Saved rows in no more partitions than their number asks for, at ``per_part`` rows each.

    Each shuffle of them then has as many map tasks and files as there are rows for.
    """
    parts = max(1, -(-rows.count() // per_part))
    few = parts < int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.coalesce(parts) if few else rows


def learnable(doc_id: str = "doc_id") -> Column:
    """Rows that may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return ~held_out(doc_id)


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text, modulo 5, is 0; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_ids(rows: DataFrame, by: list[str], most: int, doc_id: str = "doc_id") -> DataFrame:
    """At most ``most`` ids of each group in ``by``, the smallest by hash: bounded and repeatable.

    The rank has an upper bound, so each task cuts its own rows before anything is shuffled.
    """
    from pyspark.sql import Window

    order = Window.partitionBy(*by).orderBy(F.xxhash64(doc_id), doc_id)
    ranked = rows.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= most).drop("_rank")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, n + 1 offsets into them) of a string array; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each piece holds at most ``most`` bytes of text, or one row.

    After the last one the worker gives back what it no longer uses: it lives on for other stages.
    """
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end
    give_back()


def give_back() -> None:
    """Free memory of Arrow and of the C library goes back to the system, where the library can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values, mixed so that each bit depends on all."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


#: Bits of ``key_bits``: 8 KB to 16 MB.
KEY_BITS = (16, 27)


def key_bits(keys: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter with one hash of a long column, made by Spark, as packed bits.

    A place is pmod(xxhash64(key), 8 * length). With more than 8 million keys more than a
    sixteenth of the others get through; what follows must tell them apart anyway.
    """
    bits = min(max(KEY_BITS[0], (16 * max(keys.count(), 1)).bit_length()), KEY_BITS[1])
    place = F.pmod(F.xxhash64(column), F.lit(1 << bits)) + 1  # Spark's bitmaps count from 1
    marked = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    out = np.zeros(1 << bits - 3, np.uint8)
    for row in marked.toLocalIterator():
        at = 4096 * (row["bucket"] - 1)
        found = np.frombuffer(row["bits"], np.uint8)
        out[at : at + len(found)] = found[: len(out) - at]
    return out


def may_hold(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the bits at these places are set."""
    return bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
