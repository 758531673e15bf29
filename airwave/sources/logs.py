"""Raw ``;`` logs of the set-top boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the log format.
OPEN = "0201|0999|10"
HEARTBEAT = "0201|0999|11"
LIVE = "0201|0999|01"

# Event code -> (position of the first key field, of the second).
KEY_FIELDS = {
    (1, 2): [
        "0301|0204|03", "0301|0305|01", "0301|0305|02", "0301|0305|05", "0301|0305|06",
        "0301|0305|07", "0301|0305|08", "0301|0305|09", "0301|0305|10", "0301|0305|11",
        "0301|0305|12", "0301|0305|13", "0301|0305|14", "0301|0305|15", "0301|0305|17",
        "0301|0305|18", "0301|0305|19", "0301|0306|04", "0301|0306|05",
    ],
    (1, 3): [
        "0301|0305|20", "0301|0305|21", "0301|0305|22", "0301|0306|02", "0301|0306|03",
        "0301|1111|05", "0301|1112|05",
    ],
    (1, 4): [
        "0301|1111|01", "0301|1111|02", "0301|1111|03", "0301|1112|01", "0301|1112|02",
        "0301|1112|03",
    ],
    (1, 5): [
        "0301|0204|02", "0301|0508|01", "0301|1111|04", "0301|1112|04",
    ],
    (1, 6): [
        "0301|0204|04",
    ],
    (1, 8): [
        "0301|0306|01",
    ],
    (2, 1): [
        "0301|1010|01", "0301|1010|02", "0301|1010|03", "0301|1010|05", "0301|1010|06",
        "0301|1010|07", "0301|1010|08", "0301|1010|09", "0301|1010|10", "0301|1010|11",
    ],
}


#: Bytes of gzip text for each partition that its lines are spread to.
GZIP_BYTES = 64 << 20


def gzip_parts(spark: SparkSession, path: str, most: int = GZIP_BYTES) -> int | None:
    """Partitions for the lines of gzip files, by their size; None if no file is larger than ``most``.

    A listing of one folder or pattern through Hadoop's file system, as the read itself does.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    sizes = []
    for found in files.globStatus(at) or ():
        for file in files.listStatus(found.getPath()):
            if file.getPath().getName().endswith(".gz"):
                sizes.append(file.getLen())
    return -(-sum(sizes) // most) if sizes and max(sizes) > most else None


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Text lines without the blank ones.

    A gzip file is one task of the read whatever its size; its lines are spread right after, to
    ``partitions`` or as many as ``gzip_parts`` says.
    """
    lines = spark.read.text(path)
    partitions = partitions or gzip_parts(spark, path, GZIP_BYTES)
    if partitions:
        lines = lines.repartition(partitions)
    return lines.filter(F.col("value") != "")


def parse_raw_log(lines: DataFrame) -> DataFrame:
    """Split ``;`` lines and name the fields the jobs use.

    Trailing empty fields do not count towards ``n_fields``: they are cut off first.

    The array of fields goes through a one-element ``explode``: filters on single fields
    then stay above it, so a line is split once and not again for every condition.
    """
    fields = F.split(F.rtrim(F.col("value"), F.lit(";")), ";")
    split = lines.select(F.col("value").alias("line"), F.explode(F.array(fields)).alias("f"))
    return split.select(
        F.get("f", F.lit(0)).alias("code"),
        F.get("f", F.lit(1)).alias("time_text"),
        F.get("f", F.lit(2)).alias("uid"),
        F.get("f", F.lit(7)).alias("channel_raw"),
        F.get("f", F.lit(8)).alias("program_raw"),
        F.size("f").alias("n_fields"),
        F.col("f").alias("fields"),
        "line",
    )


def key_positions(spark: SparkSession) -> DataFrame:
    """The routing table (code, first, second): fixed, a few dozen rows."""
    rows = [
        (code, first, second)
        for (first, second), codes in KEY_FIELDS.items()
        for code in codes
    ]
    return spark.createDataFrame(rows, "code string, first int, second int")
