"""Token counts of documents in flat, unindexed token files, by a separator scan.

A flat file is a run of little-endian 16- or 32-bit ids, in which an end-of-document id follows
each document; nothing says where documents begin. Files are cut into blocks of equal size
without looking at their content. Each block is searched for the separator as one array; its
counts and its last separator then pass through a prefix scan over the blocks of a file, which
says how many documents lie before it and where the document that crosses into it began.

Defined cases: a null or empty text is a document without ids; ids after the last separator are a
last document with ``complete`` false; empty files, and tables without rows, give none; other
columns are ignored; a very long document simply crosses many blocks.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .common import batch_of, new_folder, saved, slices, text_bytes
from .tokens import tokenizer

#: Ids in a block.
BLOCK = 1 << 20
#: <|endoftext|> of the byte-level vocabulary.
SEPARATOR = 50256


def _local(path: str) -> str:
    """A URI with its three slashes."""
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def _open(path: str, write: bool = False):
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(_local(path))
    if write:
        store.create_dir(os.path.dirname(name), recursive=True)
        return store, name
    return store.open_input_file(name)


def write_flat(docs: DataFrame, folder: str, tokenizer_path: str, separator: int = SEPARATOR) -> DataFrame:
    """Write the documents' ids to flat 16-bit files in a shared folder, one for each task.

    Returns one row for each document: doc_id, file, ordinal (its place in the file), which must
    be saved or written, as that is what writes the files. A file is moved to its name when
    whole, so a task that runs twice leaves the same file.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("file", pa.string()), ("ordinal", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}.bin"
        store, final = _open(f"{folder}/{name}", write=True)
        # a name that the listing leaves out
        partial = f"{os.path.dirname(final)}/_{name}.{task.taskAttemptId()}"
        encoder, ordinal = tokenizer(tokenizer_path), 0
        with store.open_output_stream(partial) as out:
            for batch in slices(batches):
                ids, at = encoder.encode(*text_bytes(batch.column("text")))
                out.write(np.insert(ids, at[1:], separator).astype("<u2").tobytes())
                n = batch.num_rows
                place = np.arange(ordinal, ordinal + n)
                ordinal += n
                yield batch_of(schema, [batch.column("doc_id"), pa.array([name] * n), place])
        if ordinal:
            store.move(partial, final)
        else:
            store.delete_file(partial)

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, file string, ordinal long")


def blocks(spark: SparkSession, folder: str, bytes_per_id: int = 2, block: int = BLOCK) -> DataFrame:
    """(path, file, block, first, n): the blocks of all flat files of a folder; no content is read."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    ids = F.floor(F.col("length") / bytes_per_id)
    cut = files.select("path", ids.alias("ids"), F.explode(F.sequence(F.lit(0), F.floor((ids - 1) / block))).alias("block"))
    cut = cut.where("ids > 0").withColumn("first", F.col("block") * block)
    return cut.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file"), "block", "first",
        F.least(F.lit(block), F.col("ids") - F.col("first")).alias("n"),
    )


def _search(bytes_per_id: int, separator: int):
    kind = {2: "<u2", 4: "<u4"}[bytes_per_id]
    schema = pa.schema(
        [("file", pa.string()), ("block", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("ends", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _open(row["path"]) as source:
                    source.seek(row["first"] * bytes_per_id)
                    ids = np.frombuffer(source.read(row["n"] * bytes_per_id), kind)
                ends = np.flatnonzero(ids == separator) + row["first"]
                yield batch_of(schema, [[row["file"]], [row["block"]], [row["first"]], [len(ids)], pa.array([ends], pa.list_(pa.int64()))])

    return run


def scan(parts: DataFrame, bytes_per_id: int = 2, separator: int = SEPARATOR) -> DataFrame:
    """file, ordinal, start, n_tokens (without the separator), complete, for each document of the blocks.

    What is shuffled is one row for each block; its separators' positions come along as an array.
    """
    # blocks are few rows with much work: one each for a task, as far as there are tasks
    dealt = parts.repartition(F.col("file"), F.col("block"))
    found = dealt.mapInArrow(
        _search(bytes_per_id, separator), "file string, block long, first long, n long, ends array<long>"
    )
    line = Window.partitionBy("file").orderBy("block")
    earlier = line.rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select(
        "*",
        F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.max(F.array_max("ends")).over(earlier) + 1, F.lit(0)).alias("open"),
        F.lead("block").over(line).isNull().alias("last"),
    )
    stop = F.col("first") + F.col("n")
    # ids that no separator follows end with the file
    tail = F.col("last") & (F.coalesce(F.array_max("ends") + 1, F.col("open")) < stop)
    ends = F.when(tail, F.concat("ends", F.array(stop))).otherwise(F.col("ends"))
    docs = stitched.withColumn("stops", ends).select("*", F.posexplode("stops").alias("i", "stop"))
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.get("stops", F.col("i") - 1) + 1)
    return docs.select(
        "file",
        (F.col("before") + F.col("i")).alias("ordinal"),
        start.alias("start"),
        (F.col("stop") - start).alias("n_tokens"),
        (F.col("i") < F.size("ends")).alias("complete"),
    )


def count_documents(docs: DataFrame, tokenizer_path: str, block: int = BLOCK) -> DataFrame:
    """doc_id, file, ordinal, start, n_tokens, complete, through flat files in the shared folder."""
    spark = docs.sparkSession
    folder = new_folder(spark, "flat-tokens")
    index = saved(write_flat(docs, folder, tokenizer_path))
    if index.isEmpty():
        return spark.createDataFrame(
            [], "doc_id long, file string, ordinal long, start long, n_tokens long, complete boolean"
        )
    # both sides have a row for each document, which no estimate from the listing shows
    return index.join(scan(blocks(spark, folder, block=block)).hint("merge"), ["file", "ordinal"]).select(
        "doc_id", "file", "ordinal", "start", "n_tokens", "complete"
    )
