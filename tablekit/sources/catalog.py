"""Catalog listings as frames: databases, tables, columns, partitions, details.

A catalog listing is metadata the driver already holds (one entry per table); data is not touched. Descriptions come
from one statement per database and are taken apart as a column; only partition names need a statement per table.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from itertools import batched

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.schemas import CATALOG_DDL
from ..session import concurrently, scratch_path
from .datasets import storage_format

DETAIL_DDL = ("db string, tbl string, table_type string, provider string, location string, signature string, "
              "partition_columns array<string>, format string")
PARTITION_DDL = "db string, tbl string, spec string"
#: Listings that are put together before they are written.
_LISTINGS = 200


def databases(spark: SparkSession) -> DataFrame:
    rows = [(d.name, d.locationUri) for d in spark.catalog.listDatabases()]
    return spark.createDataFrame(rows, "db string, location string")


def tables(spark: SparkSession, db: str) -> DataFrame:
    """Tables of a database; none for a database that does not exist."""
    if not spark.catalog.databaseExists(db):
        return spark.createDataFrame([], "db string, tbl string, table_type string")
    rows = [(db, t.name, t.tableType) for t in spark.catalog.listTables(db) if not t.isTemporary]
    return spark.createDataFrame(rows, "db string, tbl string, table_type string")


def columns(spark: SparkSession, db: str, names: list[str]) -> DataFrame:
    """Column catalog of tables, types in full."""
    rows = [
        (db, tbl, pos, c.name, c.dataType, c.isPartition)
        for tbl in names for pos, c in enumerate(spark.catalog.listColumns(f"`{db}`.`{tbl}`"))
    ]
    return spark.createDataFrame(rows, CATALOG_DDL)


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def _fact(name: str) -> Column:
    """A fact of a table's description, NULL when it is not given."""
    found = F.regexp_extract("information", rf"(?m)^{name}: (.*)$", 1)
    return F.when(found != "", found)


def describe_tables(spark: SparkSession, dbs: Iterable[str] | None = None, width: int = 8) -> DataFrame:
    """Type, provider, location, storage format and partition columns of all tables: one statement per database.

    Temporary views are left out; so are databases that do not exist.
    """
    known = {d.name for d in spark.catalog.listDatabases()}
    listed = [spark.sql(f"SHOW TABLE EXTENDED IN {_quoted(db)} LIKE '*'")
              for db in sorted(known if dbs is None else known & set(dbs))]
    if not listed:
        return spark.createDataFrame([], DETAIL_DDL)
    found = reduce(DataFrame.unionByName, listed).where("not isTemporary")
    kind, provider = _fact("Type"), _fact("Provider")
    keys = F.split(F.regexp_extract("information", r"(?m)^Partition Columns: \[(.*)\]$", 1), ", ")
    signature = F.concat_ws(" ", provider, _fact("InputFormat"), _fact("Serde Library"), kind)
    return found.select(
        F.col("namespace").alias("db"), F.col("tableName").alias("tbl"), kind.alias("table_type"), provider.alias("provider"),
        _fact("Location").alias("location"), signature.alias("signature"),
        F.transform(F.filter(keys, lambda k: k != ""), lambda k: F.regexp_replace(k, "^`|`$", "")).alias("partition_columns"),
        storage_format(signature).alias("format"))


def details(spark: SparkSession, db: str, names: list[str]) -> DataFrame:
    """Type, provider, location and storage format of some tables of a database."""
    return describe_tables(spark, [db]).where(F.col("tbl").isin(names))


def partitions(spark: SparkSession, db: str, tbl: str) -> DataFrame:
    """Registered partitions of a partitioned table."""
    return spark.sql(f"SHOW PARTITIONS {_quoted(db, tbl)}").select(
        F.lit(db).alias("db"), F.lit(tbl).alias("tbl"), F.col("partition").alias("spec"))


def all_partitions(spark: SparkSession, described: DataFrame, width: int = 8) -> DataFrame:
    """Registered partitions of all partitioned tables of ``describe_tables``.

    The names of one table are one statement; ``width`` run at a time, and what they give is written to the shared
    folder, so no list of all partitions is held.
    """
    path = scratch_path(spark, "partitions")
    spark.createDataFrame([], PARTITION_DDL).write.parquet(path)
    named = described.where(F.size("partition_columns") > 0).select("db", "tbl").toLocalIterator()

    def write(session: SparkSession, some: tuple) -> None:
        listed = [partitions(session, r["db"], r["tbl"]) for r in some]
        reduce(DataFrame.unionByName, listed).write.mode("append").parquet(path)

    for _ in concurrently(spark, batched(named, _LISTINGS), write, width):
        pass
    return spark.read.schema(PARTITION_DDL).parquet(path)


def partition_locations(spark: SparkSession, db: str, tbl: str, specs: list[str], width: int = 8) -> DataFrame:
    """Location of each listed partition, ``width`` descriptions at a time."""
    def locate(session: SparkSession, spec: str) -> tuple:
        clause = ", ".join("`{}`='{}'".format(*s.split("=", 1)) for s in spec.split("/"))
        detail = session.sql(f"DESCRIBE FORMATTED {_quoted(db, tbl)} PARTITION ({clause})")
        found = detail.where(F.col("col_name") == "Location").select("data_type").first()
        return db, tbl, spec, found[0] if found else None

    return spark.createDataFrame(list(concurrently(spark, specs, locate, width)),
                                 "db string, tbl string, spec string, location string")


def table_location(spark: SparkSession, full_name: str) -> str | None:
    row = spark.sql(f"DESCRIBE FORMATTED {full_name}").where(F.col("col_name") == "Location").first()
    return row["data_type"] if row else None
