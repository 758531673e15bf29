"""Session defaults for running the jobs and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; on a cluster leave ``master`` to spark-submit.

    Sizing is left to the cluster: set ``spark.sql.shuffle.partitions`` so that one
    partition of the largest shuffle (the viewing stream) stays near 200 MB, and let
    adaptive execution merge the small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that all executors see: the cluster's ``spark.checkpoint.dir``.

    Where it is unset, a local session takes a temporary folder; a cluster has none that would do.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return "file://" + tempfile.mkdtemp(prefix="run-")


def saved(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder, computed now: for rows that several later steps
    read, and where a lost executor must not bring back all that went before. The table stays there."""
    at = f"{shared_folder(df.sparkSession)}/saved-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
