"""Data files of the supported formats."""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

# Default field delimiter and null marker of delimited text tables.
FIELD_DELIMITER = "\u0001"
NULL_MARKER = r"\N"
# Words in a table description that name its storage format, in the order they are tried.
FORMAT_WORDS = (("iceberg", "ICEBERG"), ("view", "VIEW"), ("parquet", "PARQUET"), ("orc", "ORC"),
                ("avro", "AVRO"), ("text", "TEXT"), ("lazysimple", "TEXT"), ("csv", "TEXT"))


@contextmanager
def text_partition_keys(spark: SparkSession):
    """Partition values stay text while the block reads: ``01`` and ``1`` are different partitions."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_parquet_tree(spark: SparkSession, path: str) -> DataFrame:
    """Parquet tree with the union of all file schemas and text partition keys."""
    with text_partition_keys(spark):
        return spark.read.option("mergeSchema", True).parquet(path)


def read_delimited(spark: SparkSession, path: str, schema: str, delimiter: str = FIELD_DELIMITER,
                   escape: str = "\\", null_marker: str = NULL_MARKER) -> DataFrame:
    """Delimited text without header or quoting, one record per line.

    An empty field is an empty string in a text column and NULL in any other; the CSV reader cannot tell
    it from the null marker, so lines are split here.
    """
    lines = spark.read.text(path, lineSep="\n")
    between = f"(?<!{re.escape(escape)}){re.escape(delimiter)}" if escape else re.escape(delimiter)
    split = lines.withColumn("_f", F.split("value", between))
    columns = []
    for i, field in enumerate(T.StructType.fromDDL(schema).fields):
        raw = F.get("_f", F.lit(i))
        text = F.regexp_replace(raw, f"{re.escape(escape)}(.)", "$1") if escape else raw
        value = F.when(raw != null_marker, text)
        columns.append(value.try_cast(field.dataType).alias(field.name))
    partition_columns = [c for c in lines.columns if c != "value"]
    return split.select(*columns, *partition_columns)


def write_delimited(df: DataFrame, path: str, delimiter: str = FIELD_DELIMITER, escape: str = "\\",
                    null_marker: str = NULL_MARKER, partition_by: list[str] | None = None) -> None:
    """Write records as delimited lines; delimiters and escapes inside a value are escaped."""
    partition_by = partition_by or []
    special = f"([{re.escape(delimiter)}{re.escape(escape)}])"
    mark = re.escape(escape).replace("$", "\\$")
    fields = [
        F.coalesce(F.regexp_replace(F.col(c).cast("string"), special, f"{mark}$1"), F.lit(null_marker))
        for c in df.columns if c not in partition_by
    ]
    df.select(F.concat_ws(delimiter, *fields).alias("value"), *partition_by).write.partitionBy(*partition_by).text(path)


def read_dataset(spark: SparkSession, fmt: str, path: str, **options) -> DataFrame:
    """Read parquet, orc, csv, text, json, or avro when its package is on the classpath."""
    fmt = fmt.lower()
    fmt = "csv" if fmt == "textfile" else fmt
    try:
        return spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as err:
        if fmt == "avro":
            raise RuntimeError("reading Avro needs the spark-avro package on the classpath") from err
        raise


def storage_format(description: Column) -> Column:
    """Storage format from the joined text of a table's provider, input format and serde."""
    text = F.lower(F.coalesce(description, F.lit("")))
    out = None
    for word, name in FORMAT_WORDS:
        out = F.when(text.contains(word), F.lit(name)) if out is None else out.when(text.contains(word), F.lit(name))
    return out.otherwise(F.lit("UNKNOWN"))
