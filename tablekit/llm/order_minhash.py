"""Document fingerprints by order MinHash. Main path in DataFrame functions only.

The k-mers are runs of words, numbered by occurrence, so that a repeated run counts each time. One hash deals them to
bins; of each bin the smallest are chosen, put back in text order and hashed together. Two texts agree in a bin if the
same runs were chosen in the same order, which edits and moves both disturb. A bin that holds one k-mer only has no order to
keep: texts of under some 128 words are told apart by which k-mers they have more than by their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tablekit.llm.common import word_array
from tablekit.session import materialize

#: Words to a k-mer, bins (a power of two), k-mers chosen of each bin.
K, BINS, CHOSEN = 3, 64, 2
#: Bits of a packed k-mer: its place in the text below, its hash (the bin on top) above.
PLACE_BITS, HASH_BITS = 30, 33
_BIN_SHIFT = PLACE_BITS + HASH_BITS - (BINS.bit_length() - 1)
_PLACE = (1 << PLACE_BITS) - 1
_HASH = (1 << HASH_BITS) - 1
_TUPLE_BITS = 40


def _pack(hashed: Column, place: Column) -> Column:
    return F.shiftleft(hashed.bitwiseAND(F.lit(_HASH)), PLACE_BITS).bitwiseOR(place.cast("long"))


def _starts(ordered: Column, same_bits: int) -> Column:
    """Indices at which a run of values that agree above ``same_bits`` starts."""
    return F.filter(F.when(F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1)).otherwise(F.array().cast("array<int>")),
                    lambda i: (i == 0) | (F.shiftright(F.get(ordered, i), same_bits)
                                          != F.shiftright(F.get(ordered, i - 1), same_bits)))


def _runs(ordered: Column, starts: Column, use) -> Column:
    """``use`` applied to the slice of each run."""
    return F.transform(starts, lambda at, r: use(F.slice(
        ordered, at + 1, F.coalesce(F.get(starts, r + 1), F.size(ordered)) - at)))


def with_signature(frame: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``, the sorted array of (bin, tuple hash) packed in longs, for the column ``text``.

    A text of fewer than ``K`` words is one k-mer; a null or blank one has an empty signature. Each step is a column of
    its own that the next one reads more than once, so that it is computed once per row.
    """
    other = [c for c in frame.columns]
    hashes = frame.withColumn("_w", F.transform(word_array(text), lambda w: F.xxhash64(w)))
    count = F.greatest(F.size("_w") - (K - 1), F.least(F.size("_w"), F.lit(1)))
    mers = F.transform(F.slice("_w", 1, count), lambda x, i: _pack(
        F.xxhash64(*[F.get("_w", i + j) for j in range(K)]), i))
    step = hashes.select(*other, F.sort_array(mers).alias("_s"))
    step = step.withColumn("_r", _starts(F.col("_s"), PLACE_BITS))
    numbered = F.flatten(_runs(F.col("_s"), F.col("_r"), lambda run: F.transform(run, lambda x, n: _pack(
        F.xxhash64(F.shiftright(x, PLACE_BITS), n), x.bitwiseAND(F.lit(_PLACE))))))
    step = step.select(*other, F.sort_array(numbered).alias("_t"))
    least = F.filter("_t", lambda x, i: (i < CHOSEN) | (F.shiftright(F.get("_t", i - CHOSEN), _BIN_SHIFT)
                                                       != F.shiftright(x, _BIN_SHIFT)))
    step = step.select(*other, least.alias("_m"))
    step = step.withColumn("_r", _starts(F.col("_m"), _BIN_SHIFT))

    def in_text_order(chosen: Column) -> Column:
        """Places above hashes, sorted, then the hashes alone make the tuple."""
        turned = F.array_sort(F.transform(chosen, lambda x: F.shiftleft(
            x.bitwiseAND(F.lit(_PLACE)), HASH_BITS).bitwiseOR(F.shiftright(x, PLACE_BITS))))
        tuple_hash = F.xxhash64(F.transform(turned, lambda x: x.bitwiseAND(F.lit(_HASH))))
        return F.shiftleft(F.shiftright(F.get(chosen, F.lit(0)), _BIN_SHIFT), _TUPLE_BITS).bitwiseOR(
            tuple_hash.bitwiseAND(F.lit((1 << _TUPLE_BITS) - 1)))

    return step.select(*other, _runs(F.col("_m"), F.col("_r"), in_text_order).alias(name))


def fingerprint_text(signature: str) -> Column:
    """A signature as text, 12 hexadecimal digits per filled bin."""
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 12, "0")), "")


def likeness(one: str, other: str) -> Column:
    """The share of bins filled in either signature in which both agree; 1 for two empty ones."""
    bins = [F.transform(c, lambda x: F.shiftright(x, _TUPLE_BITS)) for c in (one, other)]
    filled = F.size(F.array_union(*bins))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, other)) / filled)


#: Numbers to a bucket of ids.
BUCKET = 256


def _bucket(docs: DataFrame) -> Column:
    """Ids of a bucket follow one another; rows without id come last of all. Ids that are no numbers are buckets of
    their own."""
    if isinstance(docs.schema["id"].dataType, NumericType):
        return F.coalesce(F.floor(F.col("id") / BUCKET).cast("long"), F.lit((1 << 62) - 1))
    return F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("~"))


def _previous(buckets: DataFrame) -> DataFrame:
    """(bucket, previous): the bucket before each, the last before the first.

    Buckets are dealt out by ranges, so a task has its share of them in order; only the ranges' ends meet.
    """
    ranged = materialize(buckets.repartitionByRange("bucket").sortWithinPartitions("bucket")
                         .withColumn("part", F.spark_partition_id()), "fingerprint-buckets")
    ends = ranged.groupBy("part").agg(F.max("bucket").alias("last"))
    every = Window.orderBy("part")  # one row per range
    before = ends.select(F.col("part").alias("own"), F.coalesce(
        F.lag("last").over(every),
        F.last("last").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("before"))
    own = Window.partitionBy("part").orderBy("bucket")
    return (ranged.withColumn("inside", F.lag("bucket").over(own)).join(before, F.col("part") == F.col("own"))
            .select("bucket", F.coalesce("inside", "before").alias("previous")))


def with_guests(docs: DataFrame) -> DataFrame:
    """(id, text, bucket, guest): the rows of ``docs`` and, as a guest at the end of each bucket, the next one's first."""
    own = docs.withColumn("bucket", _bucket(docs)).withColumn("guest", F.lit(0))
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("text"))
    heads = own.groupBy("bucket").agg(F.min_by(F.struct("id", "text"), order).alias("head"))
    moved = heads.join(_previous(heads.select("bucket")).withColumnRenamed("bucket", "from"), F.col("bucket") == F.col("from"))
    return own.unionByName(moved.select("head.*", F.col("previous").alias("bucket"), F.lit(1).alias("guest")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, signature) of each row."""
    return with_signature(docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text")),
                          "text", "signature")


def edit_probe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How fingerprints follow an edit: each text, and the same with its last quarter taken from the next document.

    Returns (id, n_chars, edited, signature, edited_signature, next_signature). Null texts are empty. The last document
    is followed by the first; a single one by itself. Ids are numbers, or texts in the order of their bytes. Rows without id come last, rows with the same id in the order of
    their texts.
    """
    base = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    in_order = Window.partitionBy("bucket").orderBy("guest", F.col("id").asc_nulls_last(), "text")
    paired = (with_signature(with_guests(base), "text", "signature")
              .withColumn("next", F.lead(F.struct("text", "signature")).over(in_order)).where("guest = 0")
              .select("id", "text", "signature", F.col("next.text").alias("next_text"),
                      F.col("next.signature").alias("next_signature")))
    chars = F.length("text")
    quarter = F.floor(chars / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), chars - quarter), F.substring("next_text", F.lit(1), quarter))
    changed = paired.select("id", chars.cast("long").alias("n_chars"), edited.alias("edited"), "signature",
                            F.col("next_signature"))
    return with_signature(changed, "edited", "edited_signature")
