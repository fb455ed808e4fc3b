"""Order-dependent work without putting one group into one task.

Top-n per group, carrying values forward and numbering rows are usually one window per group, which
sends a hot group to a single task. Each is split here: partial results per shard or per chunk of the
order, then a small combination step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, shards: int = 64,
          rank: str | None = None) -> DataFrame:
    """First ``n`` rows of each group under ``order``, which must be a total order within a group.

    ``rank`` names a column for the place within the group, counted from 1.

    A first pass keeps ``n`` rows per (group, shard), so the second pass sorts at most
    ``shards * n`` rows of any group.
    """
    shard = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(shards))
    near = Window.partitionBy(*keys, "_shard").orderBy(*order)
    far = Window.partitionBy(*keys).orderBy(*order)
    found = (
        df.withColumn("_shard", shard)
        .withColumn("_rn", F.row_number().over(near))
        .where(F.col("_rn") <= n)
        .withColumn("_rn", F.row_number().over(far))
        .where(F.col("_rn") <= n)
        .drop("_shard")
    )
    return found.withColumnRenamed("_rn", rank) if rank else found.drop("_rn")


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", salts: int = 32) -> DataFrame:
    """Join in which a key that holds much of ``big`` is spread over ``salts`` tasks.

    ``small`` has few rows per key and is repeated once per salt. The result is not partitioned by the
    keys alone, so a following group-by on more columns gets a shuffle of its own.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.lit(salts))
    spread = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return big.withColumn("_salt", salt).join(spread, [*keys, "_salt"], how).drop("_salt")


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One whole row per key: the one with the greatest order value. A plain aggregate, so hot keys
    are combined before the shuffle."""
    return _pick(df, keys, order, F.max_by)


def earliest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One whole row per key: the one with the smallest order value."""
    return _pick(df, keys, order, F.min_by)


def _pick(df: DataFrame, keys: list[str], order: list[Column], choose) -> DataFrame:
    payload = [c for c in df.columns if c not in keys]
    row = choose(F.struct(*payload), F.struct(*order)).alias("_row")
    picked = df.groupBy(*keys).agg(row)
    return picked.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in payload]).select(*df.columns)


def carry_forward(df: DataFrame, keys: list[str], index: str, values: dict[str, Column],
                  chunk_rows: int = 65_536) -> DataFrame:
    """For each row, the last non-NULL struct of each value at or before it in ``index`` order.

    ``index`` is the row number within the group. Rows are cut into chunks of the index; a chunk
    is one window, and a chunk's start value is the maximum over the earlier chunks' summaries. Every
    value must be a struct that begins with the index, so that "last" is the greatest struct.
    """
    df = df.withColumn("_chunk", F.floor(F.col(index) / F.lit(chunk_rows)))
    for name, value in values.items():
        df = df.withColumn(name, value)
    here = Window.partitionBy(*keys, "_chunk").orderBy(index)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy(*keys, "_chunk").agg(*[F.max(v).alias(v) for v in values])
    starts = starts.select(*keys, "_chunk", *[F.max(v).over(before).alias(f"_start_{v}") for v in values])
    filled = df
    for name in values:
        filled = filled.withColumn(name, F.max(name).over(here))
    filled = filled.join(starts, [*keys, "_chunk"], "left")
    for name in values:
        filled = filled.withColumn(name, F.coalesce(name, f"_start_{name}"))
    return filled.drop("_chunk", *[f"_start_{v}" for v in values])


def number_rows(df: DataFrame, bins: list[Column], order: list[Column], out: str, start: int = 0) -> DataFrame:
    """Global row numbers without a global sort.

    The first bins are dealt out by ranges, and only the ranges' sizes are added up in one task. ``bins`` cut the rows step by step along ``order`` (each ascending within the one before), the last
    ones into pieces that fit a task. Only the sizes of bins are added up, siblings together.
    """
    names = [f"_bin{i}" for i in range(len(bins))]
    df = df.withColumns(dict(zip(names, bins)))
    sizes = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    first = sizes.groupBy(names[0]).agg(F.sum("_n").alias("_n")).repartitionByRange(names[0])
    first = materialize(first.withColumn("_range", F.spark_partition_id()), "ranges")  # one dealing for both sums
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = first.groupBy("_range").agg(F.sum("_n").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(names[0]).rowsBetween(Window.unboundedPreceding, -1)
    level = first.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(starts, "_range")
    offsets = sizes.join(level.select(names[0], (F.col("_start") + F.col("_in")).alias("_o0")), names[:1])
    for depth in range(1, len(names)):
        level = sizes.groupBy(*names[:depth + 1]).agg(F.sum("_n").alias("_n"))
        before = Window.partitionBy(*names[:depth]).orderBy(names[depth]).rowsBetween(Window.unboundedPreceding, -1)
        level = level.select(*names[:depth + 1], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(f"_o{depth}"))
        offsets = offsets.join(level, names[:depth + 1])
    total = F.lit(start)
    for depth in range(len(names)):
        total = total + F.col(f"_o{depth}")
    within = Window.partitionBy(*names).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(within) - 1)
        .join(offsets.select(*names, total.alias("_offset")), names)
        .withColumn(out, (F.col("_offset") + F.col("_rn")).cast("bigint"))
        .drop(*names, "_rn", "_offset")
    )


def text_lists(df: DataFrame, keys: list[str], values: list[str], sep: str = ", ",
               part_size: int = 10_000) -> DataFrame:
    """Sorted distinct values of each key as text, one row per key and part.

    A key with more than ``part_size`` distinct entries gets several parts (numbered from 0 of
    ``parts``), so no row or task holds an unbounded list; nothing is cut off.
    """
    distinct = df.select(*keys, *values).distinct()
    sizes = distinct.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(part_size)).cast("bigint").alias("parts"))
    sharded = salted_join(distinct, sizes, keys).withColumn("part", F.pmod(F.xxhash64(*values), F.col("parts")))
    lists = [F.array_join(F.sort_array(F.collect_set(v)), sep).alias(v) for v in values]
    return sharded.groupBy(*keys, "part", "parts").agg(*lists)
