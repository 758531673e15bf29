"""Tab-separated text exports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from airwave.functions.text import tsv_lines


def write_tsv(
    df: DataFrame,
    path: str,
    *,
    files: int = 0,
    gzip: bool = False,
    decimals: int = 4,
    mode: str = "errorifexists",
) -> None:
    """Write rows as tab-separated lines.

    ``files`` shuffles the finished rows into that many files and leaves the work before
    it parallel; 1 is for reports, whose size is periods times items. By default every
    partition writes its own file.
    """
    lines = tsv_lines(df, decimals)
    if files:
        lines = lines.repartition(files)
    lines.write.mode(mode).option("compression", "gzip" if gzip else "none").text(path)


def write_sorted_summary(summaries: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Distinct summary rows in order of grain and period (a row per calendar period)."""
    ordered = summaries.distinct().repartition(1).sortWithinPartitions("grain", "period")
    lines = tsv_lines(ordered, decimals=6)
    lines.write.mode(mode).option("compression", "none").text(path)


def write_report(report: DataFrame, path: str, *, items: bool = False) -> None:
    """One file, whose rows the calendar bounds; of ``items``, which nothing bounds, a file per partition."""
    write_tsv(report, path, files=0 if items else 1)


def preview(df: DataFrame, n: int = 20) -> None:
    """Print the first rows; runs a job of its own."""
    df.show(n, truncate=False)
