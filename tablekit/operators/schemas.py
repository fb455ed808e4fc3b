"""Column catalogs and their comparison.

A column catalog has table keys, ``pos``, ``name``, ``type`` and optionally ``is_partition``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.types import comparable_type

TABLE_KEYS = ("db", "tbl")
CATALOG_DDL = "db string, tbl string, pos int, name string, type string, is_partition boolean"


def columns_of(spark: SparkSession, frames: dict[tuple[str, str], DataFrame],
               partition_columns: dict[tuple[str, str], list[str]] | None = None) -> DataFrame:
    """Column catalog of frames, read from their schemas (never truncated, no job)."""
    partition_columns = partition_columns or {}
    rows = []
    for (db, tbl), df in frames.items():
        keys = {c.lower() for c in partition_columns.get((db, tbl), [])}
        for pos, field in enumerate(df.schema.fields):
            rows.append((db, tbl, pos, field.name, field.dataType.simpleString(), field.name.lower() in keys))
    return spark.createDataFrame(rows, CATALOG_DDL)


def column_differences(source: DataFrame, dest: DataFrame, keys=TABLE_KEYS, normalise: bool = False,
                       noun: str = "column", pass_empty_source: bool = False) -> DataFrame:
    """One row per differing column: kind MISSING, TYPE or EXTRA with its message.

    Names meet in lower case. ``normalise`` compares the table-format form of the types. Extras
    sort after all source columns.
    """
    keys = list(keys)

    def side(df: DataFrame, prefix: str) -> DataFrame:
        kind = F.lower("type")
        return df.select(
            *keys,
            F.lower("name").alias("column"),
            F.col("pos").alias(f"{prefix}_pos"),
            kind.alias(f"{prefix}_type"),
            (comparable_type("type") if normalise else kind).alias(f"{prefix}_form"),
        )

    joined = side(source, "s").join(side(dest, "d"), [*keys, "column"], "full_outer")
    if pass_empty_source:
        joined = joined.join(source.select(*keys).distinct(), keys, "left_semi")
    kind = (
        F.when(F.col("d_form").isNull(), F.lit("MISSING"))
        .when(F.col("s_form").isNull(), F.lit("EXTRA"))
        .when(F.col("s_form") != F.col("d_form"), F.lit("TYPE"))
    )
    message = (
        F.when(F.col("kind") == "MISSING", F.concat(F.lit(f"Missing {noun}: "), F.col("column")))
        .when(F.col("kind") == "EXTRA", F.concat(F.lit(f"Extra {noun} in dest: "), F.col("column")))
        .otherwise(F.concat(F.lit(f"{_type_lead(noun)} mismatch for "), F.col("column"), F.lit(": "),
                            F.col("s_type"), F.lit(" vs "), F.col("d_type")))
    )
    position = F.when(F.col("s_pos").isNull(), F.lit(1_000_000) + F.col("d_pos")).otherwise(F.col("s_pos"))
    return (
        joined.withColumn("kind", kind)
        .where(F.col("kind").isNotNull())
        .select(*keys, "column", "kind", position.cast("int").alias("pos"), message.alias("message"))
    )


def _type_lead(noun: str) -> str:
    return "Type" if noun == "column" else f"{noun.split()[0].capitalize()} type"


def compare_schemas(source: DataFrame, dest: DataFrame, keys=TABLE_KEYS, **options) -> DataFrame:
    """Per table: do the columns match, how many differ, and the differences as ordered text.

    A table's differences fit one row because a table's columns do.
    """
    keys = list(keys)
    diffs = column_differences(source, dest, keys, **options)
    texts = diffs.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("pos", "column", "message"))).alias("_d")
    )
    tables = source.select(*keys).union(dest.select(*keys)).distinct()
    lines = F.transform(F.coalesce(F.col("_d"), F.array().cast(texts.schema["_d"].dataType)), lambda x: x["message"])
    return tables.join(texts, keys, "left").select(
        *keys,
        F.col("_d").isNull().alias("schema_match"),
        F.size(lines).alias("difference_count"),
        F.array_join(lines, "; ").alias("differences"),
        F.concat(F.array_join(F.slice(lines, 1, 3), "; "),
                 F.when(F.size(lines) > 3, F.concat(F.lit(" (+"), (F.size(lines) - 3).cast("string"), F.lit(" more)")))
                 .otherwise(F.lit(""))).alias("first_differences"),
    )


def compare_partition_columns(source: DataFrame, dest: DataFrame, keys=TABLE_KEYS) -> DataFrame:
    """Like ``compare_schemas`` for partition columns; a source without any matches everything."""
    only = F.col("is_partition")
    return compare_schemas(source.where(only), dest.where(only), keys, noun="partition column",
                           pass_empty_source=True)
