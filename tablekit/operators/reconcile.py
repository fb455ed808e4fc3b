"""Source against destination: counts, verdicts, messages, summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import percent_difference
from ..functions.paths import col
from ..session import materialize
from . import partitions as parts

# Verdicts of a comparison.
VALIDATED = "VALIDATED"
WARNINGS = "VALIDATED_WITH_WARNINGS"
FAILED = "VALIDATION_FAILED"
EMPTY = "EMPTY_SOURCE"


def count_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table in one job."""
    counts = [
        df.groupBy().agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def scoped_counts(tables: dict[str, tuple[DataFrame, list[str]]], selected: DataFrame) -> DataFrame:
    """Row count of each table within its selected partitions; 0 when none was selected.

    ``tables`` maps a name to its frame and partition columns, ``selected`` has ``tbl`` and ``spec``.
    The selection is stored once, as every table's count reads it; each count then prunes its own table.
    """
    selected = materialize(selected.select("tbl", "spec").distinct(), "selected")
    return count_tables({
        name: parts.restrict(df, selected.where(F.col("tbl") == name), columns)
        for name, (df, columns) in tables.items()
    })


def counts_match(source, dest) -> Column:
    """Equality that stays NULL when the source was not counted."""
    return col(source) == col(dest)


def verdict(rows, partitions, schema, partition_schema=True, source_rows=None, dest_rows=None,
            schema_decides: bool = True) -> Column:
    """Overall status of a compared table from its (nullable) checks.

    Rows not counted, or a count mismatch, is a warning; a schema mismatch is a failure. With
    ``schema_decides=False`` a count mismatch stays a warning even when the schema differs too.
    """
    def check(c):
        return F.lit(c) if isinstance(c, bool) else col(c)

    rows, partitions = check(rows), check(partitions)
    schemas = F.coalesce(check(schema), F.lit(False)) & F.coalesce(check(partition_schema), F.lit(True))
    rows_ok, parts_ok = F.coalesce(rows, F.lit(False)), F.coalesce(partitions, F.lit(True))
    passed = rows_ok & parts_ok & schemas
    counts_differ = ~F.coalesce(rows, F.lit(True)) | ~parts_ok
    unknown_rows = rows.isNull() & schemas
    warn = (counts_differ & schemas) if schema_decides else counts_differ
    result = F.when(passed, F.lit(VALIDATED)).when(warn | unknown_rows, F.lit(WARNINGS)).otherwise(F.lit(FAILED))
    if source_rows is None:
        return result
    nothing = F.coalesce((col(source_rows) == 0) & (col(dest_rows) == 0), F.lit(False))
    return F.when(passed & nothing, F.lit(EMPTY)).otherwise(result)


def mismatch_message(source_rows="source_rows", dest_rows="dest_rows", source_parts="source_partitions",
                     dest_parts="dest_partitions", schema_text=None, partition_schema_text=None) -> Column:
    """The failed checks as text, NULL when there is none."""
    def differs(what: str, a, b) -> Column:
        text = F.concat(F.lit(f"{what} count mismatch: source="), col(a).cast("string"),
                        F.lit(", dest="), col(b).cast("string"))
        return F.when(col(a) != col(b), text)

    def listed(what: str, c) -> Column:
        c = col(c)
        return F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{what} differences: "), c))

    not_counted = F.when(col(source_rows).isNull(), F.lit("Row count not checked: source count not collected"))
    pieces = [F.coalesce(not_counted, differs("Row", source_rows, dest_rows)),
              differs("Partition", source_parts, dest_parts)]
    if schema_text is not None:
        pieces.append(listed("Schema", schema_text))
    if partition_schema_text is not None:
        pieces.append(listed("Partition schema", partition_schema_text))
    text = F.concat_ws("; ", *pieces)
    return F.when(text != "", text)


def compare_counts(source: DataFrame, dest: DataFrame, keys: list[str]) -> DataFrame:
    """Per-partition row counts of both sides, missing partitions as zero rows."""
    left = source.select(*keys, F.col("row_count").alias("source_rows"))
    right = dest.select(*keys, F.col("row_count").alias("dest_rows"))
    both = left.join(right, keys, "full_outer")
    return both.select(
        *keys,
        F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("dest_rows", F.lit(0)).alias("dest_rows"),
        F.col("source_rows").isNotNull().alias("in_source"),
        F.col("dest_rows").isNotNull().alias("in_dest"),
    )


def reconcile(source_counts: DataFrame, dest_counts: DataFrame, table_keys: list[str],
              partition_keys: list[str], schemas: DataFrame | None = None,
              partition_schemas: DataFrame | None = None, schema_decides: bool = True) -> DataFrame:
    """One verdict row per table (slice) from per-partition counts and optional schema checks.

    The row data was already reduced to partition counts, so nothing here scales with rows.
    """
    both = compare_counts(source_counts, dest_counts, [*table_keys, *partition_keys])
    out = both.groupBy(*table_keys).agg(
        F.sum("source_rows").alias("source_rows"),
        F.sum("dest_rows").alias("dest_rows"),
        F.count_if("in_source").alias("source_partitions"),
        F.count_if("in_dest").alias("dest_partitions"),
        F.count_if(F.col("source_rows") != F.col("dest_rows")).alias("differing_partitions"),
    )

    def with_check(df: DataFrame, checks: DataFrame | None, match: str, text: str) -> DataFrame:
        if checks is None:
            return df.withColumn(match, F.lit(True)).withColumn(text, F.lit(None).cast("string"))
        picked = checks.select(*table_keys, F.col("schema_match").alias(match),
                               F.col("first_differences").alias(text))
        return df.join(picked, table_keys, "left").withColumn(match, F.coalesce(match, F.lit(True)))

    out = with_check(out, schemas, "schema_match", "_schema_text")
    out = with_check(out, partition_schemas, "partition_schema_match", "_part_text")
    out = out.withColumn("row_count_match", counts_match("source_rows", "dest_rows"))
    out = out.withColumn("partition_count_match", counts_match("source_partitions", "dest_partitions"))
    return out.withColumn(
        "status",
        verdict("row_count_match", "partition_count_match", "schema_match", "partition_schema_match",
                "source_rows", "dest_rows", schema_decides),
    ).withColumn(
        "error_message", mismatch_message(schema_text="_schema_text", partition_schema_text="_part_text")
    ).drop("_schema_text", "_part_text")


def presence_verdict(path_exists, metadata_exists, file_count) -> Column:
    """CONFIRMED, MISSING, or FAILED when existence could not be looked up (NULL)."""
    exists, metadata = col(path_exists), col(metadata_exists)
    return (
        F.when(exists.isNull(), F.lit("FAILED"))
        .when(exists & F.coalesce(metadata, F.lit(False)) & (F.coalesce(col(file_count), F.lit(0)) > 0),
              F.lit("CONFIRMED"))
        .otherwise(F.lit("MISSING"))
    )


def validation_summary(checked: DataFrame, partition_schema: str | None = None) -> DataFrame:
    """Counts of passed, failed and mismatching tables; unknown (NULL) checks count as neither."""
    rows, partitions, schema = F.col("row_count_match"), F.col("partition_count_match"), F.col("schema_match")
    schema_bad = ~schema if partition_schema is None else (~schema | ~F.col(partition_schema))
    return checked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(rows & partitions & schema).alias("passed"),
        F.count_if(~rows | ~partitions | ~schema).alias("failed"),
        F.count_if(~rows).alias("row_count_mismatches"),
        F.count_if(~partitions).alias("partition_count_mismatches"),
        F.count_if(schema_bad).alias("schema_mismatches"),
    )


def transfer_summary(copies: DataFrame) -> DataFrame:
    """Totals of finished copies: match counts, bytes on both sides, difference in percent."""
    out = copies.agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if("size_match").alias("size_matches"),
        F.count_if(~F.col("size_match")).alias("size_mismatches"),
        F.count_if("file_count_match").alias("file_count_matches"),
        F.count_if(~F.col("file_count_match")).alias("file_count_mismatches"),
        F.coalesce(F.sum("source_bytes"), F.lit(0)).alias("source_bytes"),
        F.coalesce(F.sum("dest_bytes"), F.lit(0)).alias("dest_bytes"),
    )
    return out.withColumn("difference_percent", percent_difference("source_bytes", "dest_bytes"))
