"""Listing directories in tasks, level by level, with the names that Spark's own listing hides."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

_ENTRY_DDL = "root string, path string, rel_path string, length bigint, mtime timestamp, is_dir boolean"
_ENTRY = pa.schema([("root", pa.string()), ("path", pa.string()), ("rel_path", pa.string()), ("length", pa.int64()),
                    ("mtime", pa.timestamp("us", "UTC")), ("is_dir", pa.bool_())])


def _entries(folder: str) -> Iterator[tuple[str, str, int, int, bool]]:
    """(path, name, length, mtime in microseconds, is_dir) of a directory; nothing if it is gone or a file.

    Links are entries of their own and not followed, so a listing ends.
    """
    local = folder.removeprefix("file:") if folder.startswith("file:") else folder
    if "://" not in local:
        try:
            found = os.scandir(local)
        except (FileNotFoundError, NotADirectoryError):
            return
        with found:
            for entry in found:
                try:
                    about, is_dir = entry.stat(follow_symlinks=False), entry.is_dir(follow_symlinks=False)
                except FileNotFoundError:  # gone since the directory was opened
                    continue
                yield f"{folder}/{entry.name}", entry.name, about.st_size, about.st_mtime_ns // 1000, is_dir
        return
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        moment = int((info.mtime_ns or 0) // 1000)
        yield f"{folder}/{info.base_name}", info.base_name, info.size or 0, moment, info.type == fs.FileType.Directory


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            found = [(row["root"], path, f"{row['rel_path']}/{name}".lstrip("/"), length, mtime, is_dir)
                     for path, name, length, mtime, is_dir in _entries(row["path"])]
            for start in range(0, len(found), 10_000):
                columns = zip(*found[start:start + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ENTRY)], schema=_ENTRY)


def list_entries(spark: SparkSession, roots: str | list[str] | DataFrame, width: int | None = None) -> DataFrame:
    """Every file and directory under the roots: (root, path, rel_path, length, mtime, is_dir), hidden names included.

    A level of directories is dealt out over ``width`` tasks, which list them; the directories found are the next level.
    ``roots`` are locations that every executor reaches (a shared folder, or a store that Arrow knows by its URI), as one
    path, a list, or a frame with the column ``root``. A missing root gives no rows.
    """
    if not isinstance(roots, DataFrame):
        named = [roots] if isinstance(roots, str) else roots
        roots = spark.createDataFrame([(r,) for r in named], "root string")
    width = width or spark.sparkContext.defaultParallelism
    level = roots.select("root", F.regexp_replace("root", "/+$", "").alias("path"), F.lit("").alias("rel_path")).distinct()
    levels = []
    while True:
        found = materialize(level.repartition(width, "path").mapInArrow(_list, _ENTRY_DDL), "listing")
        levels.append(found)
        level = found.where("is_dir").select("root", "path", "rel_path")
        if level.isEmpty():
            return reduce(DataFrame.unionByName, levels)


def inventory(spark: SparkSession, roots: str | list[str] | DataFrame, width: int | None = None) -> DataFrame:
    """The files of ``list_entries``, as ``files.file_inventory`` gives them, but with hidden names."""
    return list_entries(spark, roots, width).where("not is_dir").drop("is_dir")


def partition_directories(entries: DataFrame, depth: int) -> DataFrame:
    """(root, spec) of the partition directories ``depth`` levels down, also those without files."""
    spec = rf"^(?:[^/=]+=[^/]*/){{{depth - 1}}}[^/=]+=[^/]*$"
    return entries.where(F.col("is_dir") & F.col("rel_path").rlike(spec)).select("root", F.col("rel_path").alias("spec"))
