"""Registering many external tables and their partitions.

Decisions and statements are made for all tables at once, as columns; the statements themselves go to the catalog, a
bounded number at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.paths import drop_trailing_slash, local_path
from ..session import concurrently, materialize
from ..sources.catalog import all_partitions, describe_tables
from ..sources.datasets import text_partition_keys
from . import partitions as parts
from .lifecycle import creation_decision, external_ddl, quoted

#: Partitions of one ADD or DROP statement, about.
BATCH = 500
RESULT_DDL = "db string, tbl string, status string, action string, error string"


def _identifier(name: Column) -> Column:
    return F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))


def _text(value: Column) -> Column:
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.concat(F.lit("'"), escaped, F.lit("'"))


def partition_clause(spec: str) -> Column:
    """PARTITION (k = 'v', ...) of a spec; the default partition's value is null."""
    def pair(e: Column) -> Column:
        value = F.when(e["v"] == parts.DEFAULT_PARTITION, F.lit("null")).otherwise(_text(e["v"]))
        return F.concat(_identifier(e["k"]), F.lit(" = "), value)

    return F.concat(F.lit("PARTITION ("), F.array_join(F.transform(parts.spec_entries(spec), pair), ", "), F.lit(")"))


def partition_changes(registered: DataFrame, wanted: DataFrame) -> DataFrame:
    """(db, tbl, spec, change) of every partition on either side: ADD, DROP or KEEP."""
    left = registered.select(*parts.TABLE_KEYS, "spec").distinct().withColumn("_r", F.lit(True))
    right = wanted.select(*parts.TABLE_KEYS, "spec").distinct().withColumn("_w", F.lit(True))
    change = F.when(F.col("_r").isNull(), F.lit("ADD")).when(F.col("_w").isNull(), F.lit("DROP")).otherwise(F.lit("KEEP"))
    return left.join(right, [*parts.TABLE_KEYS, "spec"], "full_outer").select(*parts.TABLE_KEYS, "spec", change.alias("change"))


def partition_statements(changes: DataFrame, tables: DataFrame, batch: int = BATCH) -> DataFrame:
    """(db, tbl, statement): additions and removals of ``partition_changes`` in statements of about ``batch`` partitions.

    ``tables`` has db, tbl and location. Partitions are dealt out by their hash, so a table with very many becomes many
    small groups.
    """
    todo = changes.where("change <> 'KEEP'")
    sizes = todo.groupBy(*parts.TABLE_KEYS, "change").agg(F.ceil(F.count("*") / F.lit(batch)).alias("batches"))
    place = F.concat(F.lit(" LOCATION "), _text(F.concat(drop_trailing_slash("location"), F.lit("/"), F.col("spec"))))
    clause = F.concat(partition_clause("spec"), F.when(F.col("change") == "ADD", place).otherwise(F.lit("")))
    dealt = (todo.join(sizes, [*parts.TABLE_KEYS, "change"])
             .join(tables.select(*parts.TABLE_KEYS, "location"), list(parts.TABLE_KEYS))
             .select(*parts.TABLE_KEYS, "change", F.pmod(F.xxhash64("spec"), "batches").alias("batch"), clause.alias("clause")))
    clauses = F.sort_array(F.collect_list("clause"))
    name = F.concat(_identifier(F.col("db")), F.lit("."), _identifier(F.col("tbl")))
    statement = F.concat(F.lit("ALTER TABLE "), name,
                         F.when(F.col("change") == "ADD", F.concat(F.lit(" ADD IF NOT EXISTS "), F.array_join("clauses", " ")))
                         .otherwise(F.concat(F.lit(" DROP IF EXISTS "), F.array_join("clauses", ", "))))
    return (dealt.groupBy(*parts.TABLE_KEYS, "change", "batch").agg(clauses.alias("clauses"))
            .select(*parts.TABLE_KEYS, statement.alias("statement")))


def set_partitions(spark: SparkSession, tables: DataFrame, wanted: DataFrame, width: int = 8) -> DataFrame:
    """Make exactly the ``wanted`` (db, tbl, spec) the registered partitions of ``tables``, with or without data.

    (db, tbl, added, dropped, kept, error) of every table; one that fails does not stop the others.
    """
    described = describe_tables(spark, [r["db"] for r in tables.select("db").distinct().collect()])
    ours = described.join(tables.select(*parts.TABLE_KEYS), list(parts.TABLE_KEYS), "left_semi")
    changes = materialize(partition_changes(
        all_partitions(spark, ours, width), wanted.join(tables.select(*parts.TABLE_KEYS), list(parts.TABLE_KEYS), "left_semi")),
        "partition-changes")

    def run(session: SparkSession, row) -> tuple:
        try:
            session.sql(row["statement"])
            return row["db"], row["tbl"], None
        except Exception as err:  # noqa: BLE001 - one bad table must not stop the others
            return row["db"], row["tbl"], str(err)

    statements = materialize(partition_statements(changes, tables), "partition-statements").orderBy(
        F.col("statement").contains(" DROP IF EXISTS ").desc())
    failed = [r for r in concurrently(spark, statements.toLocalIterator(), run, width) if r[2]]
    errors = spark.createDataFrame(failed, "db string, tbl string, error string").groupBy(*parts.TABLE_KEYS).agg(
        F.min("error").alias("error"))
    counts = changes.groupBy(*parts.TABLE_KEYS).agg(*[
        F.count_if(F.col("change") == c).alias(a) for c, a in (("ADD", "added"), ("DROP", "dropped"), ("KEEP", "kept"))])
    return (tables.select(*parts.TABLE_KEYS).join(counts, list(parts.TABLE_KEYS), "left").fillna(0, ["added", "dropped", "kept"])
            .join(errors, list(parts.TABLE_KEYS), "left"))


def registration_plan(spark: SparkSession, specs: DataFrame, recreate: bool = False) -> DataFrame:
    """``specs`` with the decision (CREATE, REPAIR, RECREATE or REFUSE) and its reason: one listing per database."""
    described = describe_tables(spark, [r["db"] for r in specs.select("db").distinct().collect()]).select(
        *parts.TABLE_KEYS, F.col("location").alias("here"), F.lit(True).alias("found"), F.col("format").alias("here_format"))
    asked = specs.join(described, list(parts.TABLE_KEYS), "left")
    decided = creation_decision(F.coalesce("found", F.lit(False)), F.lit(recreate), F.col("here_format"),
                                local_path("here"), local_path("location"))
    return asked.withColumn("d", decided).select(*[specs[c] for c in specs.columns], "found", "d.decision", "d.reason")


def register_tables(spark: SparkSession, specs: DataFrame, recreate: bool = False, selected: DataFrame | None = None,
                    width: int = 8) -> DataFrame:
    """Create or repair the external tables of ``table_specs``, ``width`` at a time; one result row per table.

    Without columns the schema is inferred from the files. A table that lies elsewhere is refused. Partitions are those
    on storage, or, for the tables that ``selected`` (db, tbl, spec) names, exactly the selected ones: others are taken
    out, new ones put in, also those without data.
    """
    plan = materialize(registration_plan(spark, specs, recreate), "registrations")
    for row in plan.select("db").distinct().collect():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(row['db'])}")
    chosen = set() if selected is None else {tuple(r) for r in selected.select(*parts.TABLE_KEYS).distinct().collect()}

    def register(session: SparkSession, row) -> tuple:
        try:
            action, reason = _register(session, row, (row["db"], row["tbl"]) not in chosen)
            return row["db"], row["tbl"], "FAILED" if action == "REFUSE" else "COMPLETED", action, reason
        except AnalysisException as err:
            return row["db"], row["tbl"], "FAILED", "ERROR", str(err)

    done = spark.createDataFrame(list(concurrently(spark, plan.toLocalIterator(), register, width)), RESULT_DDL)
    if selected is None:
        return done
    sound = done.where("status = 'COMPLETED'").select(*parts.TABLE_KEYS)
    mine = specs.join(sound, list(parts.TABLE_KEYS), "left_semi").join(
        selected.select(*parts.TABLE_KEYS).distinct(), list(parts.TABLE_KEYS), "left_semi")
    changed = set_partitions(spark, mine.select(*parts.TABLE_KEYS, "location"), selected, width)
    changed = changed.withColumnRenamed("error", "partition_error")
    joined = done.join(changed, list(parts.TABLE_KEYS), "left")
    return joined.select(
        *parts.TABLE_KEYS, F.when(F.col("partition_error").isNotNull(), F.lit("FAILED")).otherwise(F.col("status")).alias("status"),
        "action", F.coalesce("error", "partition_error").alias("error"), "added", "dropped", "kept")


def _register(spark: SparkSession, row, all_on_storage: bool) -> tuple[str, str | None]:
    name, action = quoted(row["db"], row["tbl"]), row["decision"]
    if action == "REFUSE":
        return action, row["reason"]
    keys = [(c["name"], c["type"]) for c in row["partition_columns"] or []]
    if action == "REPAIR":
        if all_on_storage and any(c.isPartition for c in spark.catalog.listColumns(name)):
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        spark.sql(f"REFRESH TABLE {name}")
        return action, None
    columns = [(c["name"], c["type"]) for c in row["columns"] or []]
    if not columns:
        with text_partition_keys(spark):
            found = spark.read.format(row["format"].lower()).load(row["location"]).schema.fields
        named = {k for k, _ in keys}
        columns = [(f.name, f.dataType.simpleString()) for f in found if f.name not in named]
    if row["found"]:
        spark.sql(f"DROP TABLE {name}")  # external: the data stays
    spark.sql(external_ddl(row["db"], row["tbl"], columns, keys, row["location"], row["format"]))
    if keys and all_on_storage:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return action, None
