"""Reports as files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the report on partitions outside their table.
OUTSIDE_COLUMNS = ("database", "table", "partition", "location", "exists", "file_count", "size_bytes", "row_count")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(path)


def write_outside_report(outside: DataFrame, path: str) -> None:
    """Partitions outside their table directory, one line each; uncounted rows stay empty."""
    write_csv(outside.select(*OUTSIDE_COLUMNS), path)


def write_issue_report(issues: DataFrame, summary: DataFrame, path: str) -> None:
    """Issues and their summary as two JSON datasets, issues split by severity."""
    issues.write.partitionBy("severity").json(f"{path}/issues")
    summary.write.json(f"{path}/summary")


def ordered_by_table(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("source_database"), F.col("source_table"))
