"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame, which is written as
Parquet to the shared folder and read again as the next stage's documents. All but the last return
the columns of documents; the last returns the packed pieces with their token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from airwave.llm import decontamination, language_id, near_dedup, packing, pii
from airwave.llm.common import new_folder, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the documents themselves teach; rejected texts go."""
    return language_id.accepted(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the first by id, of each group of near duplicates; repeated rows go as well."""
    return near_dedup.one_of_each(docs, repeated=False)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked."""
    return pii.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their ids, packed into sequences."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", known_language),
    ("near_dedup", one_of_each),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: Languages are learned, packing places are found by a greedy rule: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
