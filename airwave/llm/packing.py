"""Packing by shortest-pack-first over the length histogram.

Documents become token ids with an end id, cut into pieces of at most ``length`` ids. Only the
histogram of piece lengths (one row for each possible length) comes to the driver. There, lengths
are placed longest first, each on the pattern of packs that is shortest so far if it fits, which
splits or extends pattern counts; no single piece is looked at. A placement says: the pieces of
this length with ranks a to b lie at this offset of sequences c to c + b - a. Pieces are then
ranked inside their length and find their placement by rank; their ids go along.

Defined cases: a null or empty text is the end id alone; a null doc_id is kept as it is; repeated
rows are pieces of their own; an empty table gives no rows; other columns of the documents are
not carried along.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from .common import batch_of, give_back, saved, slices, text_bytes
from .tokens import tokenizer

LENGTH = 1024
END_ID = 0
#: Rows of one length that are ranked in one group, and their ids.
GROUP_ROWS = 100_000
GROUP_IDS = 1 << 23

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Bytes of text that go through the tokenizer at once.
ENCODED_BYTES = 1 << 20


def _id_width(path: str) -> str:
    """The narrowest type that holds a tokenizer's ids, for ids on their way through Spark."""
    return "<u2" if tokenizer(path).library.get_vocab_size() <= 1 << 16 else "<u4"


def _cut(path: str, length: int, with_ids: bool, narrow: str | None = None) -> Callable:
    fields = [pa.field(x.split()[0], pa.int64()) for x in PIECES.split(", ")]
    schema = pa.schema(fields + [pa.field("ids", pa.binary() if narrow else pa.list_(pa.int32()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path)
        for batch in slices(batches, most=ENCODED_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            ids, at = encoder.encode(data, offsets)
            n = batch.num_rows
            ids = np.insert(ids, at[1:], END_ID).astype("<u4")
            at = at + np.arange(n + 1)
            tokens = np.diff(at)
            parts = -(-tokens // length)
            doc = np.repeat(np.arange(n), parts)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * length
            size = np.minimum(tokens[doc] - start, length)
            first = at[doc] + start
            crc = [zlib.crc32(ids[a : a + s]) for a, s in zip(first.tolist(), size.tolist(), strict=True)]
            columns = [batch.column("doc_id").take(pa.array(doc)), start, size, crc, tokens[doc]]
            if with_ids:  # pieces lie one after the other, so their ids are the ids of the slice
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                if narrow:
                    ends *= np.dtype(narrow).itemsize
                    columns.append(pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(ids.astype(narrow))]))
                else:
                    columns.append(pa.ListArray.from_arrays(ends, ids.astype(np.int32)))
            yield batch_of(schema, columns)
        encoder.clear()
        give_back()

    return run


def pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """One row for each piece of each document; ``ids`` too if asked for."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return rows.mapInArrow(_cut(tokenizer_path, length, with_ids), PIECES + ", ids array<int>" * with_ids)


def place(histogram: dict[int, int], length: int = LENGTH) -> pd.DataFrame:
    """Placements of all pieces: size, rank, n, sequence, offset (the first of each and how many).

    Groups of packs with equal patterns are ranges of sequences, kept by the room that is left. At
    most one new group for each step, and at most length**2 / 2 placements in all.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(length + 1)]
    placed, sequences, most = [], 0, 0
    for size in sorted(histogram, reverse=True):
        rank, left = 0, histogram[size]
        while left:
            while most > 0 and not room[most]:
                most -= 1
            if most >= size:  # the shortest packs have the most room
                first, n = room[most].pop()
                used, free = min(n, left), most
                if used < n:
                    room[most].append((first + used, n - used))
            else:
                first, used, free = sequences, left, length
                sequences += left
            placed.append((size, rank, used, first, length - free))
            room[free - size].append((first, used))
            most = max(most, free - size)
            rank, left = rank + used, left - used
    return pd.DataFrame(placed, columns=["size", "rank", "n", "sequence", "offset"], dtype="int64")


def pack(cut: DataFrame, length: int = LENGTH, narrow: str = "<u2") -> DataFrame:
    """Pieces (with ``length`` and any other columns) with ``sequence_id`` and ``offset``.

    ``ids``, if they are bytes, hold numbers of type ``narrow`` and come out as an array of these.
    ``cut`` is read three times, so give it saved. A length that many pieces share is ranked in
    groups by a hash, whose counts are summed up before.
    """
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    at = place(counts, length)
    names = [c for c in ("doc_id", "start", "ids_crc32", "doc_tokens") if c in cut.columns]
    parts = np.ones(length + 1, np.int64)
    for size, n in counts.items():
        parts[size] = -(-n // min(GROUP_ROWS, max(1, GROUP_IDS // size)))
    groups = F.array(*[F.lit(int(p)) for p in parts])
    rows = cut.withColumn("_group", F.pmod(F.xxhash64(*names), F.element_at(groups, (F.col("length") + 1).cast("int"))))
    sizes = rows.groupBy("length", "_group").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_group").orderBy(*names)
    ranked = rows.withColumn("_rank", F.row_number().over(inside) - 1).join(sizes, ["length", "_group"])

    numbers = {"ids": ArrayType(IntegerType())} if dict(cut.dtypes).get("ids") == "binary" else {}
    schema = StructType([StructField(f.name, numbers.get(f.name, f.dataType)) for f in cut.schema])
    schema = schema.add("sequence_id", "long").add("offset", "long")
    placed = ranked.withColumn("_rank", F.col("_rank") + F.col("_before")).select(*cut.columns, "_rank")
    return placed.mapInArrow(_found(at, to_arrow_schema(schema), narrow if numbers else None), schema)


def _found(at: pd.DataFrame, schema: pa.Schema, narrow: str | None) -> Callable:
    """Pieces with the place of their rank; with ``narrow``, ids become numbers and ``ids_crc32`` is taken from these.

    One function for both, so that a task needs one Python worker.
    """
    # (size, rank) as one number, sorted: at most length**2 / 2 placements, a few MB
    at = at.sort_values(["size", "rank"], ignore_index=True)
    key = (at["size"].to_numpy() << 50) + at["rank"].to_numpy()
    rank0, sequence0, offset0 = (at[c].to_numpy() for c in ("rank", "sequence", "offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 2048):
                part = batch.slice(row, 2048)
                size, rank = (part.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
                p = np.searchsorted(key, (size << 50) + rank, "right") - 1
                own = {"sequence_id": sequence0[p] + rank - rank0[p], "offset": offset0[p]}
                if narrow:
                    own |= _ids(part.column("ids"), narrow)
                yield batch_of(schema, [own[n] if n in own else part.column(n) for n in schema.names])
        give_back()

    return run


def _ids(column: pa.Array, narrow: str) -> dict:
    raw = column.to_pylist()
    size = np.array([len(x) for x in raw], np.int64) // np.dtype(narrow).itemsize
    ids = np.frombuffer(b"".join(raw), narrow).astype("<u4")
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    crc = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    return {"length": size, "ids_crc32": crc, "ids": pa.ListArray.from_arrays(ends, ids.astype(np.int32))}


def packed(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """Documents to packed pieces with their ids; the pieces are saved in between."""
    narrow = _id_width(tokenizer_path)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    cut = rows.mapInArrow(_cut(tokenizer_path, length, True, narrow), PIECES + ", ids binary")
    return pack(saved(cut), length, narrow)


def sequences(packed_ids: DataFrame, length: int = LENGTH, pad: int = END_ID) -> DataFrame:
    """One row for each sequence of at most ``length`` ids: sequence_id, ids padded to ``length``.

    Takes pieces with ``ids``; a sequence holds at most ``length`` pieces, so groups are bounded.
    """
    rows = packed_ids.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.flatten(F.col("p.ids"))
    return rows.select("sequence_id", F.concat(ids, F.array_repeat(F.lit(pad), (F.lit(length) - F.size(ids)))).alias("ids"))
