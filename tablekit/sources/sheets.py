"""Control sheets as CSV, JSON or Parquet, with normalised headers."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# Columns of each kind of sheet; the required ones come first.
SHEETS = {
    "table_copy": (("database", "table", "dest_database", "bucket"), ("partition_filter", "endpoint")),
    "conversion": (("database", "table"), ("inplace_migration", "destination_iceberg_database")),
    "catalog_move": (("database", "table", "source_s3_prefix", "dest_s3_prefix"), ()),
    "registration": (("database", "table", "s3_location"), ()),
    "folder_copy": (("source_path", "target_bucket"), ("dest_folder", "endpoint", "split_subfolders")),
    "access_matrix": ((), ("role", "database", "tables", "columns", "url", "permissions", "groups", "users",
                           "rowfilter", "item_type", "policy_label")),
}


def normalise_headers(df: DataFrame) -> DataFrame:
    """Headers trimmed, in lower case, with underscores for spaces."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def as_sheet(df: DataFrame, kind: str) -> DataFrame:
    """Check a frame against a kind of sheet: required columns present, optional ones added as NULL."""
    required, optional = SHEETS[kind]
    df = normalise_headers(df)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{kind} sheet lacks column(s): {', '.join(missing)}")
    for name in optional:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    extra = [c for c in ("sheet", "row_index") if c in df.columns]
    cells = [F.col(c).cast("string").alias(c) for c in (*required, *optional)]
    return df.select(*extra, *cells)


# Whether a line ends inside a quoted field, for a line that begins outside of one, and for one that begins inside.
# A field is quoted if a quote is its first character; two quotes in it stand for one.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+)?+'
_OPEN = r'"[^"]*+(?:""[^"]*+)*+\z'
_ENDS_INSIDE = rf"^(?:{_FIELD},)*+{_OPEN}"
_STAYS_INSIDE = rf'^[^"]*+(?:""[^"]*+)*+(?:\z|"[^,]*+,(?:{_FIELD},)*+{_OPEN})'


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, row_index, text) of CSV files whose quoted cells may hold line breaks, read in pieces by many tasks.

    Lines are read where the pieces of a file lie. Each line says where it ends, inside or outside of a quoted cell, for
    both ways in which it may begin; putting these together along the lines of a piece, and then along the pieces of a
    file, tells where records begin. ``record`` counts them per file, ``row_index`` over all files in the order of their
    names, headers (record 0) left out.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", "\r$", "").alias("line"))
    from_outside, from_inside = F.col("line").rlike(_ENDS_INSIDE), F.col("line").rlike(_STAYS_INSIDE)
    lines = materialize(lines.withColumn("fixed", from_outside == from_inside)  # ends alike, however it begins
                        .withColumn("ends", from_outside).withColumn("turns", (from_outside & ~from_inside).cast("int")),
                        "sheet-lines")
    # state after a line: that of the last fixed line, turned over by each turning line since
    piece = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    inside = lines.select(
        "*", F.coalesce(F.sum("turns").over(piece), F.lit(0)).alias("turned"),
        F.max(F.when(F.col("fixed"), F.struct("at", "ends"))).over(piece).alias("last"))
    inside = inside.withColumn("turned_then", F.max(F.when(F.col("fixed"), F.struct("at", "turned"))).over(piece)["turned"])
    ends = lines.groupBy("file", "block").agg(
        F.max(F.when(F.col("fixed"), F.struct("at", "ends"))).alias("last"), F.sum("turns").alias("turns"))
    after = lines.join(ends.select("file", "block", F.col("last.at").alias("last_at")), ["file", "block"]).groupBy(
        "file", "block").agg(F.sum(F.when(F.col("last_at").isNull() | (F.col("at") > F.col("last_at")), F.col("turns"))
                                   .otherwise(0)).alias("since"))
    blocks = ends.join(after, ["file", "block"])
    states = _block_states(blocks)
    begun = inside.join(states, ["file", "block"]).withColumn(
        "within", F.when(F.col("last").isNull(), F.col("state") != (F.col("turned") % 2 == 1)).otherwise(
            F.col("last.ends") != ((F.col("turned") - F.col("turned_then")) % 2 == 1)))
    begun = materialize(begun.select("file", "block", "at", "line", (~F.col("within")).cast("int").alias("opens")), "sheet-opens")
    upto = Window.partitionBy("file", "block").orderBy("at")
    opened = begun.groupBy("file", "block").agg(F.sum("opens").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per piece
    starts = opened.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = begun.join(starts, ["file", "block"]).withColumn("record", F.col("before") + F.sum("opens").over(upto) - 1)
    whole = numbered.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "at", "line"))).alias("lines"))
    files = opened.groupBy("file").agg(F.sum("n").alias("n"))
    by_name = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    offsets = files.select("file", F.coalesce(F.sum(F.col("n") - 1).over(by_name), F.lit(0)).alias("offset"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    return whole.join(offsets, "file").select(
        "file", "record", (F.col("offset") + F.col("record") - 1).cast("long").alias("row_index"), text.alias("text"))


def _block_states(blocks: DataFrame) -> DataFrame:
    """(file, block, state): whether a piece begins inside a quoted cell. One row per piece of a file."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    known = blocks.withColumn("sums", F.coalesce(F.sum("turns").over(before), F.lit(0)))
    fixed = F.when(F.col("last").isNotNull(), F.struct(
        "block", ((F.col("last.ends").cast("int") + F.col("since")) % 2 == 1).alias("out"), (F.col("sums") + F.col("turns")).alias("sums")))
    known = known.withColumn("set", F.max(fixed).over(before))
    turned = F.col("sums") - F.coalesce("set.sums", F.lit(0))
    return known.select("file", "block", (F.coalesce("set.out", F.lit(False)) != (turned % 2 == 1)).alias("state"))


def read_csv_sheet(spark: SparkSession, path: str) -> DataFrame:
    """CSV sheets with a header as text cells and a ``row_index``, in the order of the files' names and their records.

    The header is that of the first file; columns without a name, or with one that comes twice, get their number. Blank records are left out, as Spark's reader does.
    """
    records = materialize(csv_records(spark, path), "sheet-records")
    first = records.where("record = 0").orderBy("file").select("text").first()
    if first is None:
        return spark.createDataFrame([], "row_index bigint")
    options = {"escape": '"', "maxCharsPerColumn": "-1"}
    given = [n or f"_c{i}" for i, n in enumerate(next(csv.reader([first["text"]])))]
    names = [n if given.count(n) == 1 else f"{n}{i}" for i, n in enumerate(given)]
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    rows = records.where((F.col("record") > 0) & (F.trim("text") != ""))
    return rows.select("row_index", F.from_csv("text", schema, options).alias("cells")).select("row_index", "cells.*")


def read_manifest(spark: SparkSession, path: str, kind: str, fmt: str = "csv") -> DataFrame:
    """Read a sheet with all cells as text and a ``row_index`` that gives the order of its rows.

    CSV sheets are read by many tasks, line breaks in cells included. JSON sheets with one record a line are too; their
    order is that of the files. Parquet sheets, and any sheet may, carry a ``row_index`` column.
    """
    if fmt == "csv":
        df = read_csv_sheet(spark, path)
    elif fmt == "json":
        df = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unknown sheet format {fmt!r}")
    df = normalise_headers(df)
    if "row_index" not in df.columns:
        df = df.withColumn("row_index", F.monotonically_increasing_id())
    return as_sheet(df, kind).withColumn("row_index", F.col("row_index").cast(T.LongType()))
