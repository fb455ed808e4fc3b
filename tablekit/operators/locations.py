"""Joins on paths: overlapping destinations, partitions outside their table, prefix stripping.

Each path is expanded to its ancestors (one row per level), so "is a prefix of" becomes an equality
and no join looks at all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import ancestors, drop_trailing_slash, is_inside, plain_path
from . import ordered


def overlap_pairs(destinations: DataFrame, path: str = "dest") -> DataFrame:
    """Distinct (``outer``, ``inner``) destination pairs where one lies above the other."""
    dests = destinations.select(drop_trailing_slash(path).alias("inner")).distinct()
    levels = dests.select("inner", F.explode(ancestors("inner")).alias("outer"))
    # Nearly all paths share their first levels: find the levels that are destinations at all, then salt.
    used = levels.select("outer").distinct().join(dests.select(F.col("inner").alias("outer")), "outer", "left_semi")
    return ordered.salted_join(levels, used, ["outer"], "left_semi").select("outer", "inner")


def overlaps(destinations: DataFrame, keys: list[str], path: str = "dest") -> DataFrame:
    """Every key whose destination equals, contains or lies inside another key's, and with how many.

    Rows of one key never conflict with each other. The counts are of keys at the same path
    (``same``), of keys above (``above``) and below (``below``); the pairs themselves are
    ``overlap_pairs``. Nothing grows with the square of a crowded path.
    """
    owned = destinations.select(*keys, drop_trailing_slash(path).alias("dest")).where(F.col("dest") != "").distinct()
    owners = owned.groupBy("dest").agg(F.count(F.lit(1)).alias("_owners"))
    pairs = overlap_pairs(owned)
    above = ordered.salted_join(pairs, owners.select(F.col("dest").alias("outer"), F.col("_owners").alias("_n")), ["outer"]) \
        .groupBy(F.col("inner").alias("dest")).agg(F.sum("_n").alias("above"), F.max("outer").alias("nearest_above"))
    below = pairs.join(owners.withColumnRenamed("dest", "inner").withColumnRenamed("_owners", "_n"), "inner") \
        .groupBy(F.col("outer").alias("dest")).agg(F.sum("_n").alias("below"))
    sizes = owners.join(above, "dest", "left").join(below, "dest", "left").select(
        "dest",
        (F.col("_owners") - 1).alias("same"),
        F.coalesce("above", F.lit(0)).alias("above"),
        F.coalesce("below", F.lit(0)).alias("below"),
        "nearest_above",
    ).where(F.col("same") + F.col("above") + F.col("below") > 0)
    return owned.join(sizes, "dest").select(*keys, "dest", "same", "above", "below", "nearest_above",
                                            overlap_message().alias("message"))


def overlap_message() -> Column:
    return F.concat(
        F.lit("Destination "), F.col("dest"), F.lit(" overlaps: "),
        F.col("same").cast("string"), F.lit(" at the same path, "),
        F.col("above").cast("string"), F.lit(" above, "),
        F.col("below").cast("string"), F.lit(" below"),
    )


def outside_root(located: DataFrame, roots: DataFrame, keys: list[str], location: str = "location",
                 root: str = "root") -> DataFrame:
    """Partitions whose location is not the table's root or below it; tables without a root are left out.

    Salted, as one table may own a large share of all partitions.
    """
    return ordered.salted_join(located, roots.select(*keys, root), keys).where(~is_inside(location, root))


def outside_summary(outside: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """Per table: all partitions, those outside, and their files, bytes and rows (NULL if none was counted)."""
    found = outside.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("outside_partitions"),
        F.sum(F.coalesce("file_count", F.lit(0))).alias("total_files"),
        F.sum(F.coalesce("size_bytes", F.lit(0))).alias("total_bytes"),
        F.sum("row_count").alias("total_rows"),
    )
    out = totals.join(found, keys, "left")
    for name in ("outside_partitions", "total_files", "total_bytes"):
        out = out.withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def strip_longest_prefix(paths: DataFrame, prefixes: DataFrame, path: str = "path",
                         prefix: str = "prefix") -> DataFrame:
    """Add ``matched_prefix`` (longest listed prefix ending at a segment boundary) and ``relative``.

    ``relative`` has no outer slashes and is NULL when nothing is left, or there was no path.
    """
    distinct = paths.select(path).distinct().withColumn("_plain", plain_path(path))
    wanted = prefixes.select(plain_path(prefix).alias("_level")).where(F.col("_level") != "").distinct()
    levels = distinct.select(path, F.explode(ancestors("_plain", include_self=True)).alias("_level"))
    best = levels.join(wanted, "_level", "left_semi").groupBy(path).agg(
        F.max_by("_level", F.length("_level")).alias("matched_prefix")
    )
    rest = F.substring(F.col("_plain"), F.length(F.coalesce("matched_prefix", F.lit(""))) + 1, F.length("_plain"))
    relative = F.regexp_replace(rest, "^/+|/+$", "")
    found = distinct.join(best, path, "left").select(
        path, "matched_prefix", F.when(relative != "", relative).alias("relative")
    )
    return paths.join(found, path, "left")


def source_relative_destination(paths: DataFrame, prefixes: DataFrame, bucket: Column | str,
                                path: str = "path") -> DataFrame:
    """Destination that keeps the source path under a bucket; NULL with a reason when not possible."""
    out = strip_longest_prefix(paths, prefixes, path)
    dest = F.concat(drop_trailing_slash(bucket), F.lit("/"), F.col("relative"))
    reason = F.when(F.col("relative").isNull(), F.concat(
        F.lit("Nothing left of the source location "), F.coalesce(path, F.lit("")), F.lit(" for a destination")))
    return out.withColumn("dest", dest).withColumn("error", reason)
