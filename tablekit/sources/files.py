"""File inventories: listings, counts and bytes per path, partition directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.paths import drop_trailing_slash

INVENTORY_DDL = "root string, path string, rel_path string, length bigint, mtime timestamp"


def file_inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Every file under a root with its size; file contents are never read.

    Names that start with ``_`` or ``.`` are hidden by Spark's listing. A missing root gives no rows.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(root)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return spark.createDataFrame([], INVENTORY_DDL)
        raise
    plain_root = root.split("://", 1)[-1].split(":", 1)[-1].rstrip("/")
    relative = F.substring_index(F.col("path"), plain_root + "/", -1)
    decoded = F.coalesce(F.try_url_decode(F.replace(relative, F.lit("+"), F.lit("%2B"))), relative)
    return files.select(
        F.lit(root).alias("root"), "path", decoded.alias("rel_path"), "length",
        F.col("modificationTime").alias("mtime"))


def path_totals(files: DataFrame, keys: list[str]) -> DataFrame:
    """File count and bytes per key."""
    return files.groupBy(*keys).agg(F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("size_bytes"))


def partition_files(files: DataFrame) -> DataFrame:
    """Inventory with the partition ``spec`` of each file: its leading directories named ``k=v``."""
    folder = F.regexp_extract("rel_path", r"^((?:[^/=]+=[^/]*/)*)", 1)
    return files.withColumn("spec", drop_trailing_slash(folder))


def partition_specs(files: DataFrame, depth: int | None = None) -> DataFrame:
    """Distinct partition specs that hold files, of the table's depth if given."""
    specs = partition_files(files).where(F.col("spec") != "").select("root", "spec").distinct()
    if depth is not None:
        specs = specs.where(F.size(F.split("spec", "/")) == depth)
    return specs


def partition_keys(specs: DataFrame) -> list[str]:
    """Partition column names in directory order, read from one spec."""
    row = specs.select("spec").first()
    return [s.split("=", 1)[0] for s in row["spec"].split("/")] if row else []


def registered_directories(spark: SparkSession, table: str) -> DataFrame:
    """All partition directories of an external table, empty ones too, as registered by a repair."""
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.sql(f"SHOW PARTITIONS {table}").select(F.col("partition").alias("spec"))


def tables_with_metadata(files: DataFrame) -> DataFrame:
    """First-level directories that hold a ``metadata`` folder."""
    return files.where(F.col("rel_path").rlike(r"^[^/]+/metadata/")).select(
        "root", F.substring_index("rel_path", "/", 1).alias("tbl")).distinct()


def read_sources(spark: SparkSession, root: str) -> DataFrame:
    """Source files under a root as (path, text), one row per file."""
    files = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def make_directory(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder))
