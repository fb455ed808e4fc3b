"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Main path in DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.session import materialize

#: Hexadecimal digits of the sampling hash that name a bucket: 16**3 sums per source stand for its documents.
BUCKET_DIGITS = 3


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sampling_hash(id_col: str, seed: int) -> Column:
    """The seeded place of a document in its source; rows with the same id share it."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def source_targets(sizes: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """(source, source_size, target) from one row per source with its ``source_size``.

    A source above its cap gives the excess to the others by weight, again and again. Sources reach their caps in
    the order of cap / weight, so the rounds are prefix sums in that order: a source is clamped when even its share of
    what the clamped ones before it leave is at least its cap. The rest share the remaining words at one level.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source, not per document
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    place = (F.row_number().over(by_name) - 1) % n
    ranked = (sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1))
              .withColumn("cap", F.col("source_size").cast("double") * max_epochs)
              .withColumn("ratio", F.col("cap") / F.col("weight"))
              .withColumn("level", (F.sum("source_size").over(Window.partitionBy()).cast("double")
                                    - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                          / F.sum("weight").over(after)))
    free = F.when(F.col("level") < F.col("ratio"), F.struct(F.col("ratio").alias("r"), F.col("level").alias("l")))
    return (ranked.withColumn("at", F.min(free).over(Window.partitionBy())["l"])
            .select("source", "source_size",
                    F.least(F.col("cap"), F.coalesce(F.col("at") * F.col("weight"), F.col("cap"))).alias("target")))


def mix_plan(facts: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """(source, source_size, target, whole, cut): each document is repeated ``whole`` times, once more up to ``cut``.

    ``facts`` has one row per document: source, size, place. The documents of a source in the order of ``place`` are
    filled up to the words that whole repetitions leave open; the last one counts if its middle is inside. Sums per
    bucket of places find the bucket in which the filling ends, and only its documents are put in order.
    """
    bucket = F.substring("place", 1, BUCKET_DIGITS)
    sums = materialize(facts.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")), "mix-sums")
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")),
                                                     F.lit(max_epochs).cast("long"))).otherwise(F.lit(0)).cast("long")
    targets = (targets.withColumn("whole", whole)
               .withColumn("open", F.col("target") - F.col("whole") * F.col("source_size"))
               .withColumnRenamed("source", "own"))
    in_order = Window.partitionBy("source").orderBy("bucket")
    filled = (sums.join(targets, F.col("source").eqNullSafe(F.col("own")))
              .withColumn("end", F.sum("words").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("start", F.col("end") - F.col("words")))
    ends = materialize(
        filled.groupBy("own", "source_size", "target", "whole", "open")
        .agg(F.max(F.when(F.col("end") <= F.col("open"), F.col("bucket"))).alias("full"),
             F.min(F.when((F.col("end") > F.col("open")) & (F.col("start") < F.col("open")),
                          F.struct("bucket", "start"))).alias("edge")), "mix-ends")
    units = (facts.join(ends.select("own", "open", "edge"), F.col("source").eqNullSafe(F.col("own"))
                        & (bucket == F.col("edge.bucket")))
             .groupBy("own", "place", "open", "edge").agg(F.sum("size").alias("size")))
    middle = (F.col("edge.start") + F.sum("size").over(Window.partitionBy("own").orderBy("place"))
              - F.col("size") / F.lit(2.0))
    cuts = (units.withColumn("middle", middle).where(F.col("middle") <= F.col("open"))
            .groupBy(F.col("own").alias("cut_own")).agg(F.max("place").alias("cut")))
    # "g" is greater than every hexadecimal digit: the whole bucket
    return materialize(
        ends.join(cuts, F.col("own").eqNullSafe(F.col("cut_own")), "left")
        .select(F.col("own").alias("mix_source"), "source_size", "target", "whole",
                F.coalesce("cut", F.concat("full", F.lit("g")), F.lit("")).alias("cut")), "mix-plan")


def _facts(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
                       sampling_hash(id_col, seed).alias("place"))


def _copies() -> Column:
    return F.col("whole") + (F.col("place") <= F.col("cut")).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: int = 7,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, copies, taken) of every document.

    ``size`` counts words, 0 for null or blank texts. Sources in code point order, null last, get the weights in turn.
    Targets share the words of all documents; none exceeds ``max_epochs`` times its source. A document is taken
    ``copies`` times: the whole repetitions of its source, and one more if its seeded place is among the first. The
    words taken of a source differ from its target by half of one document at most. Rows with the same id get the same
    number of copies. An empty table gives an empty result.
    """
    facts = materialize(_facts(docs, seed, id_col, text_col, source_col), "mix-facts")
    plan = mix_plan(facts, weights, max_epochs)
    return (facts.join(plan, F.col("source").eqNullSafe(F.col("mix_source")))
            .select("id", "size", "source_size", "target", _copies().alias("copies"),
                    (F.col("size") * _copies()).alias("taken")))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: int = 7,
                    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The input's columns, each document as many times as ``mix`` takes it."""
    plan = mix_plan(materialize(_facts(docs, seed, id_col, text_col, source_col), "mix-facts"), weights, max_epochs)
    own = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                      docs[source_col].alias("source"), sampling_hash(id_col, seed).alias("place"))
    taken = (own.join(plan, F.col("source").eqNullSafe(F.col("mix_source")))
             .select("row", F.explode(F.array_repeat(F.lit(1), _copies().cast("int"))).alias("copy")))
    return taken.select(*[F.col("row")[c].alias(c) for c in docs.columns])
