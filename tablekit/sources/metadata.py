"""Table-format metadata documents: which file is current, schema, partition spec, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import drop_trailing_slash
from ..functions.types import partition_transform, with_sql_type

# Types of fields stay JSON text, as a nested type is an object and a primitive a word.
DOCUMENT_DDL = """
`format-version` INT, `location` STRING, `current-schema-id` INT, `default-spec-id` INT,
`current-snapshot-id` BIGINT,
`schemas` ARRAY<STRUCT<`schema-id`: INT, `fields`: ARRAY<STRUCT<`id`: INT, `name`: STRING, `type`: STRING>>>>,
`partition-specs` ARRAY<STRUCT<`spec-id`: INT,
    `fields`: ARRAY<STRUCT<`name`: STRING, `transform`: STRING, `source-id`: INT>>>>,
`snapshots` ARRAY<STRUCT<`snapshot-id`: BIGINT, `manifest-list`: STRING, `summary`: MAP<STRING, STRING>>>
"""


def current_metadata_files(files: DataFrame, hints: DataFrame | None = None) -> DataFrame:
    """Current metadata file of each table: the one a version hint names, else the highest number.

    ``files`` is an inventory of the folder above the tables; ``hints`` has root, tbl and version.
    """
    name = F.substring_index("rel_path", "/", -1)
    docs = files.where(F.col("rel_path").rlike(r"^[^/]+/metadata/[^/]+\.metadata\.json$")).select(
        "root", F.substring_index("rel_path", "/", 1).alias("tbl"), "path", name.alias("name"),
        F.coalesce(F.regexp_extract(name, r"^v?(\d+)", 1).try_cast("bigint"), F.lit(-1)).alias("version"))
    newest = docs.groupBy("root", "tbl").agg(F.max_by("path", F.struct("version", "name")).alias("path"))
    if hints is None:
        return newest
    named = docs.join(hints, ["root", "tbl"]).where(F.col("name") == F.concat(
        F.lit("v"), F.trim(hints["version"].cast("string")), F.lit(".metadata.json")))
    hinted = named.groupBy("root", "tbl").agg(F.max("path").alias("_hinted"))
    return newest.join(hinted, ["root", "tbl"], "left").select(
        "root", "tbl", F.coalesce("_hinted", "path").alias("path"))


def version_hints(spark: SparkSession, root: str) -> DataFrame:
    """Version hints of the tables under a root."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "version-hint.text").text(
        root, wholetext=True)
    folder = F.regexp_extract("_metadata.file_path", r"([^/]+)/metadata/[^/]+$", 1)
    return text.select(F.lit(root).alias("root"), folder.alias("tbl"), F.regexp_replace("value", r"\s+", "").alias("version"))


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """Every metadata document under a root with its path; join with the current files to pick."""
    docs = spark.read.schema(DOCUMENT_DDL).option("multiLine", True).option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.metadata.json").json(root)
    return docs.select(F.col("_metadata.file_path").alias("path"), "*")


def current_documents(spark: SparkSession, root: str, files: DataFrame, hints: DataFrame | None = None) -> DataFrame:
    current = current_metadata_files(files, hints)
    plain = F.regexp_replace("path", r"^file:/+", "/")
    docs = read_documents(spark, root).withColumn("path", plain)
    return current.withColumn("path", plain).join(docs, "path")


def _chosen(items: str, id_field: str, wanted: str) -> Column:
    """Entry with the wanted id, else the last one."""
    same = F.filter(F.col(f"`{items}`"), lambda x: x[id_field] == F.coalesce(F.col(f"`{wanted}`"), F.lit(0)))
    return F.coalesce(F.try_element_at(same, F.lit(1)), F.try_element_at(F.col(f"`{items}`"), F.lit(-1)))


def schema_columns(documents: DataFrame, keys=("tbl",)) -> DataFrame:
    """Columns of each document's current schema with SQL types."""
    fields = _chosen("schemas", "schema-id", "current-schema-id")["fields"]
    rows = documents.select(*keys, F.posexplode(fields).alias("pos", "_f"))
    rows = rows.select(*keys, "pos", F.col("_f.name").alias("name"), F.col("_f.type").alias("json_type"))
    return with_sql_type(rows, "json_type", "type").select(*keys, "pos", "name", "type")


def partition_fields(documents: DataFrame, keys=("tbl",)) -> DataFrame:
    """Fields of each document's default partition spec: source column, transform, parameter, name."""
    spec = _chosen("partition-specs", "spec-id", "default-spec-id")["fields"]
    fields = _chosen("schemas", "schema-id", "current-schema-id")["fields"]
    rows = documents.select(*keys, fields.alias("_cols"), F.posexplode(spec).alias("pos", "_p"))
    source = F.try_element_at(F.filter("_cols", lambda c: c["id"] == F.col("_p.source-id")), F.lit(1))["name"]
    unknown = F.concat(F.lit("field_"), F.col("_p.source-id").cast("string"))
    transform = partition_transform(F.coalesce(F.col("_p.transform"), F.lit("identity")))
    return rows.select(
        *keys, "pos", F.coalesce(source, unknown).alias("source_column"),
        transform["transform"].alias("transform"), transform["param"].alias("param"),
        F.coalesce(F.col("_p.name"), source, unknown).alias("name"))


def snapshot_facts(documents: DataFrame, keys=("tbl",)) -> DataFrame:
    """Per document: format version, snapshot count, row count of the current snapshot, partitioned or not."""
    current = F.try_element_at(
        F.filter("snapshots", lambda s: s["snapshot-id"] == F.col("current-snapshot-id")), F.lit(1))
    total = F.try_element_at(current["summary"], F.lit("total-records")).try_cast("bigint")
    spec = _chosen("partition-specs", "spec-id", "default-spec-id")["fields"]
    return documents.select(
        *keys, F.col("format-version").alias("format_version"),
        F.coalesce(F.size("snapshots"), F.lit(0)).alias("snapshot_count"),
        F.coalesce(total, F.lit(0)).alias("row_count"),
        (F.coalesce(F.size(spec), F.lit(0)) > 0).alias("is_partitioned"))


def snapshots(documents: DataFrame, keys=("tbl",)) -> DataFrame:
    """One row per snapshot with its manifest list."""
    return documents.select(*keys, F.explode("snapshots").alias("_s")).select(
        *keys, F.col("_s.snapshot-id").alias("snapshot_id"), F.col("_s.manifest-list").alias("manifest_list"))


def check_rewrite(dest_snapshots: DataFrame, expected: DataFrame, keys=("tbl",)) -> DataFrame:
    """Per table: no snapshot still points under the source prefix, and the snapshot count is the source's.

    ``expected`` has the keys, source_prefix, dest_prefix and source_snapshots. Equal or empty
    prefixes mean nothing was rewritten; an unknown source count (0) matches.
    """
    keys = list(keys)
    src, dst = drop_trailing_slash(F.coalesce("source_prefix", F.lit(""))), drop_trailing_slash("dest_prefix")
    rows = expected.withColumn("_src", src).withColumn("_skip", (src == "") | (src == dst))
    joined = rows.join(dest_snapshots, keys, "left")
    stale = F.col("manifest_list").startswith(F.col("_src")) & ~F.col("_skip")
    out = joined.groupBy(*keys).agg(
        F.count("manifest_list").alias("dest_snapshots"), F.count_if(stale).alias("stale_snapshots"),
        F.max("source_snapshots").alias("source_snapshots"))
    count_ok = (F.col("source_snapshots") <= 0) | (F.col("source_snapshots") == F.col("dest_snapshots"))
    return out.withColumn("rewrite_ok", F.col("stale_snapshots") == 0).withColumn("snapshot_count_match", count_ok)


