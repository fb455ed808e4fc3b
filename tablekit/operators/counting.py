"""Row counts of many tables where they lie: one scan per storage format, whatever the number of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import ancestors, local_path
from ..session import materialize
from ..sources.listing import list_entries
from .partitions import decode_value


def file_counts(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """(path, row_count) of every file under the paths, in one scan that reads no column.

    Parquet and ORC answer it from their footers. Rows of one file are added up where they are read.
    """
    rows = spark.read.format(fmt).schema(T.StructType([])).option("recursiveFileLookup", True).load(paths)
    return rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("row_count"))


def by_table(counts: DataFrame, tables: DataFrame) -> DataFrame:
    """(table_name, row_count): every file goes with the table whose location is the longest above it; 0 without files."""
    places = tables.select("table_name", local_path("location").alias("_place"))
    files = counts.select(local_path(decode_value("path")).alias("_file"), "row_count")
    above = files.select("_file", "row_count", F.explode(ancestors("_file", include_self=True)).alias("_place"))
    own = above.join(places, "_place").groupBy("_file", "row_count").agg(
        F.max(F.struct(F.length("_place"), "_place"))["_place"].alias("_place"))
    sums = own.groupBy("_place").agg(F.sum("row_count").alias("row_count"))
    return places.join(sums, "_place", "left").select("table_name", F.coalesce("row_count", F.lit(0)).alias("row_count"))


def _counted(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """``file_counts`` of (fmt, path) rows; the list of paths is what Spark's own file index holds too."""
    wanted: dict[str, list[str]] = {}
    for fmt, path in paths.select("fmt", "path").distinct().collect():
        wanted.setdefault(fmt, []).append(path)
    none = spark.createDataFrame([], "path string, row_count bigint")
    return reduce(DataFrame.unionByName, [file_counts(spark, sorted(p), f) for f, p in sorted(wanted.items())], none)


def count_locations(spark: SparkSession, tables: DataFrame) -> DataFrame:
    """(table_name, row_count) of (table_name, location, format): one scan per format."""
    return by_table(_counted(spark, tables.select(F.lower("format").alias("fmt"), F.col("location").alias("path"))), tables)


def count_selected(spark: SparkSession, tables: DataFrame, selected: DataFrame) -> DataFrame:
    """(table_name, row_count) within the selected (table_name, spec) partition directories; 0 when none was selected.

    Only selected directories that are there are read, all of them in one scan per format.
    """
    chosen = tables.join(selected.select("table_name", "spec").distinct(), "table_name").select(
        F.lower("format").alias("fmt"), F.concat(F.regexp_replace("location", "/+$", ""), F.lit("/"), F.col("spec")).alias("path"))
    chosen = materialize(chosen, "selected")
    there = list_entries(spark, tables.select(F.col("location").alias("root"))).where("is_dir").select("path")
    return by_table(_counted(spark, chosen.join(there, "path", "left_semi")), tables)
