"""Connected components of a graph too large for one machine: alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.session import in_few_files, materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node hands the smallest id it sees to its larger (or smaller) neighbours."""
    if large:
        near = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = near.groupBy(F.col("a").alias("own")).agg(F.min("b").alias("low"))
    low = low.select("own", F.least("own", "low").alias("low"))
    told = near.join(low, F.col("a") == F.col("own"))
    if large:
        out = told.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = (told.select(F.col("b").alias("a"), F.col("low").alias("b"))
               .unionByName(low.select(F.col("own").alias("a"), F.col("low").alias("b"))))
    return out.where(F.col("a") != F.col("b")).distinct()


def _summary(edges: DataFrame) -> tuple:
    """Count and sum of hashes: equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b); the component is its smallest node.

    Large and small stars in turn bring every node next to the smallest one of its component after a number of rounds
    that grows with the logarithm of the graph. Each round is written to the shared folder. Smallest ids come from
    aggregates with partial sums, so nodes with very many neighbours are no bottleneck. Ids must not be null.
    """
    now = materialize(in_few_files(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                                   .where(F.col("a") != F.col("b")).distinct()), label)
    state = _summary(now)
    while True:
        now = materialize(in_few_files(_stars(_stars(now, large=True), large=False)), label)
        before, state = state, _summary(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
