"""N-gram Jaccard join: rare-first prefixes meet, length, positional and suffix filters thin the pairs, each is verified once.

``near_links`` is the join: every link between different sets is tested and returned. ``near_groups`` has the components
of the links only. There a shared n-gram first brings each document to a few leaders, and all remaining pairs of an n-gram
are made between documents that are still in different components: a pair inside a component can add nothing. While it
is leaders that are met, each document tries the closest one only; what it leaves out is tried across components.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import keyed, text_bytes
from tablekit.llm.components import components
from tablekit.llm.filters import filter_of, held, read_filter
from tablekit.session import in_few_files, materialize, release

#: Slots of the table of n-gram counts (a power of two). Its size is fixed; n-grams that share a slot share its count,
#: which orders them but decides nothing.
SLOTS = 1 << 22
_CHUNK = 1 << 16
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHORT = 0x5EED


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``k`` words, A-Z lower-cased; a shorter text is one run."""
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), _SHORT)], np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    mixed = hashed[: len(words) - k + 1]
    for i in range(1, k):
        mixed = mixed * _MIX + hashed[i: len(words) - k + 1 + i]
    return np.unique(_mixed(mixed))


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) & (SLOTS - 1)


#: Parts into which the suffix filter cuts a set by hash; each keeps its size modulo 32.
PARTS = 60
_FIELD, _FIELDS = 6, 10  # bits for a size, the highest one spare, and sizes to a column
_PACKED = [f"p{i}" for i in range(PARTS // _FIELDS)]
_SHIFTS = np.arange(_FIELDS) * _FIELD
_EACH = sum(1 << int(i) for i in _SHIFTS)  # a one in every field


def _parts(hashes: np.ndarray) -> np.ndarray:
    sizes = np.bincount((hashes % np.uint64(PARTS)).astype(np.int64), minlength=PARTS) & 31
    return (sizes.reshape(len(_PACKED), _FIELDS) << _SHIFTS).sum(axis=1)


def _name(own: np.ndarray) -> np.ndarray:
    """Two numbers that name a set: sets with equal ones are equal."""
    return np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), "<i8")


def _profile(k: int):
    """Rows (id, n, s1, s2) of documents and, at the end of a partition, its n-gram counts (chunk, counts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int32)
        kind = None
        for batch in batches:
            kind = batch.column("id").type
            n, first, second = [], [], []
            for text in text_bytes(batch.column("text")):
                own = shingle_set(text, k)
                np.add.at(counts, _slots(own), 1)
                a, b = _name(own)
                n.append(len(own)), first.append(a), second.append(b)
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                 pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=["id", "n", "s1", "s2", "chunk", "counts"])
        if kind is not None:
            chunks = [(i // _CHUNK, counts[i:i + _CHUNK]) for i in range(0, SLOTS, _CHUNK)]
            full = [(i, zlib.compress(c.tobytes(), 1)) for i, c in chunks if c.any()]
            none = [pa.nulls(len(full), t) for t in (kind, *[pa.int64()] * 3)]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array([i for i, _ in full], pa.int32()), pa.array([c for _, c in full], pa.binary())],
                names=["id", "n", "s1", "s2", "chunk", "counts"])
    return run


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a partition's chunks added up."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            sums[chunk] = sums.get(chunk, 0) + np.frombuffer(zlib.decompress(counts), np.int32).astype(np.int64)
    # rarer than four times in the corpus is rare; beyond that the logarithm orders
    ranks = {c: np.minimum(8 * np.log2(np.maximum(s, 1)), 255).astype(np.uint8).tobytes() for c, s in sums.items()}
    yield pa.RecordBatch.from_arrays([pa.array(list(ranks), pa.int32()), pa.array(list(ranks.values()), pa.binary())],
                                     names=["chunk", "ranks"])


def _prefix(own: np.ndarray, threshold: Fraction, ranks: np.ndarray) -> np.ndarray:
    """The n-grams of a set of which a linked set must have one: rarest first, as many as the threshold spares, and one."""
    length = len(own) - math.ceil(threshold * len(own)) + 1 if len(own) else 0
    return own[np.lexsort((own, ranks[_slots(own)]))[:length]]


def _size_bits(sizes: np.ndarray, t: Fraction) -> np.ndarray:
    """One of 64 bits for each size of a set: sizes that may link have the same one or neighbours, the last being next to
    the first."""
    if t >= 1:
        at = sizes
    elif t <= 0:
        at = np.zeros(len(sizes))
    else:  # a little wider than the threshold, so that rounding parts no sizes that may link
        at = np.floor(np.log(np.maximum(sizes, 1)) / (math.log(1 / t) * (1 + 1e-9)))
    return (np.uint64(1) << (at % 64).astype(np.uint64)).view(np.int64)


def _prefix_grams(k: int, threshold: Fraction, shared_ranks):
    """Rows (h, size) of the n-grams of all prefixes and the bits of their sets' sizes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = np.frombuffer(shared_ranks.value, np.uint8)
        for batch in batches:
            sizes, grams = [], []
            for text in text_bytes(batch.column("text")):
                own = shingle_set(text, k)
                sizes.append(len(own)), grams.append(_prefix(own, threshold, ranks))
            bits = np.repeat(_size_bits(np.array(sizes, np.int64), threshold), [len(g) for g in grams])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams).view(np.int64)), pa.array(bits)], names=["h", "size"])
    return run


def _meeting(grams: DataFrame) -> DataFrame:
    """The n-grams (h) that two sets have of which the sizes allow a link; others bring no pair together."""
    sizes = F.col("sizes")
    beside = F.shiftleft(sizes, 1).bitwiseOR(F.shiftrightunsigned(sizes, 63))
    found = grams.groupBy("h").agg(F.count("*").alias("n"), F.bit_or("size").alias("sizes"))
    return found.where((F.bit_count(sizes) < F.col("n")) | (sizes.bitwiseAND(beside) != 0)).select("h")


def _active(k: int, threshold: Fraction, shared_ranks, shared_filter, with_text: bool):
    """Rows (id, s1, s2[, text], n, grams, places, p0...): documents with n-grams in the filter, these, their places in
    the prefix, and the sizes of the set's parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = np.frombuffer(shared_ranks.value, np.uint8)
        table = read_filter(shared_filter.value)
        for batch in batches:
            rows, names, sizes, grams, places, parts = [], [], [], [], [], []
            for i, text in enumerate(text_bytes(batch.column("text"))):
                own = shingle_set(text, k)
                prefix = _prefix(own, threshold, ranks)
                shared = np.flatnonzero(held(prefix, table))
                if len(shared):
                    rows.append(i), names.append(_name(own)), sizes.append(len(own)), grams.append(prefix[shared].view(np.int64)), places.append(shared)
                    parts.append(_parts(own))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), *[pa.array([x[i] for x in names], pa.int64()) for i in (0, 1)],
                 *([batch.column("text").take(at)] if with_text else []), pa.array(sizes, pa.int32()),
                 pa.array(grams, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32())),
                 *[pa.array(x) for x in np.array(parts, np.int64).reshape(len(rows), len(_PACKED)).T]],
                names=["id", "s1", "s2", *(["text"] if with_text else []), "n", "grams", "places", *_PACKED])
    return run


def _least_common(n_a: Column, n_b: Column, t: Fraction) -> Column:
    """The smallest intersection with which sets of these sizes link: t / (1 + t) of the sum, rounded up."""
    up, down = t.numerator, t.numerator + t.denominator
    return F.floor(((n_a + n_b).cast("long") * up + (down - 1)) / F.lit(down)).cast("long")


def _may_link(t: Fraction, first: bool = False) -> Column:
    """Length and positional filter over a pair met in one n-gram: (id, n, pos) and (other, other_n, other_pos).

    Where all pairs of an n-gram meet, the ``first`` n-gram that two sets share is enough: nothing before it is common.
    """
    n_a, n_b = F.col("n").cast("long"), F.col("other_n").cast("long")
    most = F.least(F.col("n") - F.col("pos"), F.col("other_n") - F.col("other_pos"))
    if not first:  # grams before this one in either prefix may be common too, up to the smaller of both places
        most = most + F.least(F.col("pos"), F.col("other_pos"))
    return ((n_a * t.denominator >= n_b * t.numerator) & (n_b * t.denominator >= n_a * t.numerator)
            & (most >= _least_common(n_a, n_b, t)))


def _apart() -> Column:
    """By how much the sets of a pair differ at least: the differences in size of their parts, the short way round 32.

    All fields of a column are worked on together; code of one step per part is too long to be compiled at run time.
    """
    def fields(c: str) -> Column:
        apart = (F.col(c).bitwiseOR(F.lit(_EACH << 5)) - F.col(f"other_{c}")).bitwiseAND(F.lit(_EACH * 31))
        far = F.shiftright(apart, 4).bitwiseAND(F.lit(_EACH))  # 16 and more: the other way round is as short or shorter
        return apart.bitwiseXOR(far * 31) + far

    wide = F.lit(sum(63 << 2 * _FIELD * i for i in range(_FIELDS // 2)))
    total = F.lit(0)
    for i in range(0, len(_PACKED), 3):  # three differences of at most 16 fit a field, all together a field of double width
        three = fields(_PACKED[i]) + fields(_PACKED[i + 1]) + fields(_PACKED[i + 2])
        total = total + three.bitwiseAND(wide) + F.shiftright(three, _FIELD).bitwiseAND(wide)
    return total % ((1 << 2 * _FIELD) - 1)  # the sum of the fields


def _suffix_may_link(t: Fraction) -> Column:
    """Suffix filter over a pair met in one n-gram."""
    n_a, n_b = F.col("n").cast("long"), F.col("other_n").cast("long")
    return _apart() <= n_a + n_b - 2 * _least_common(n_a, n_b, t)


def _verify(pairs: DataFrame, texts: DataFrame, k: int, t: Fraction) -> DataFrame:
    """The pairs (a, b) whose sets really overlap enough; each text is read from ``texts`` (id, text)."""
    id_type = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last = None, None
        for batch in batches:
            keep = []
            for one, two in zip(text_bytes(batch.column("text_a")), text_bytes(batch.column("text_b")), strict=True):
                if one != last:
                    known, last = shingle_set(one, k), one
                other = shingle_set(two, k)
                common = len(np.intersect1d(known, other, assume_unique=True))
                keep.append(t.denominator * common >= t.numerator * (len(known) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    texts = _in_pairs(texts, pairs).repartition("id")  # one pass and one shuffle for both sides
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(run, f"a {id_type}, b {id_type}")


def _in_pairs(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``texts`` of the documents in the pairs, and few others: a filter of fixed size keeps the rest from the shuffle."""
    return _passing(texts, F.xxhash64("id"), pairs.select(F.explode(F.array(F.xxhash64("a"), F.xxhash64("b"))).alias("h")))


def _passing(rows: DataFrame, h: Column, hashes: DataFrame) -> DataFrame:
    """``rows`` with ``h`` among the ``hashes`` (h), and few others: a filter of fixed size stands for the hashes."""
    table = rows.sparkSession.sparkContext.broadcast(filter_of(hashes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = read_filter(table.value)
        for batch in batches:
            yield batch.filter(pa.array(held(batch.column("h").to_numpy().view(np.uint64), bits)))

    rows = rows.withColumn("h", h)
    return rows.mapInArrow(run, rows.schema).drop("h")


def _prepare(docs: DataFrame, k: int, threshold: Fraction, id_col: str, text_col: str,
             with_text: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What both operators start from: (id, n, s1, s2) of each row; (id, rep, s1, s2) of each with an id and words; and the rows with n-grams that can link them (``_active``)."""
    spark = docs.sparkSession
    own = keyed(docs, id_col, text_col).select("id", "text")
    id_type = own.schema["id"].dataType.simpleString()
    # one pass over the texts: sizes, set hashes and n-gram counts
    profile = materialize(own.mapInArrow(_profile(k), f"id {id_type}, n bigint, s1 bigint, s2 bigint, chunk int, counts binary"),
                          "jaccard-profile")
    members = profile.where("chunk IS NULL").select("id", "n", "s1", "s2")
    ranks = (profile.where("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk")
             .mapInArrow(_add_counts, "chunk int, ranks binary").collect())  # SLOTS bytes, whatever the corpus
    table = np.zeros(SLOTS, np.uint8)
    for r in ranks:
        table[r["chunk"] * _CHUNK:(r["chunk"] + 1) * _CHUNK] = np.frombuffer(r["ranks"], np.uint8)
    shared = spark.sparkContext.broadcast(table.tobytes())

    # equal sets are linked as they are; the first document stands for them
    named = members.where("id IS NOT NULL AND n > 0")
    firsts = named.groupBy("s1", "s2").agg(F.min("id").alias("rep"))
    standing = materialize(named.join(firsts, ["s1", "s2"]).select("id", "rep", "s1", "s2"), "jaccard-standing")

    # n-grams found in two prefixes or more, of sets whose sizes allow a link, as a filter of fixed size; it picks the
    # documents that can be linked at all
    named_texts = own.where("id IS NOT NULL")
    common = _meeting(named_texts.select("text").mapInArrow(_prefix_grams(k, threshold, shared), "h bigint, size bigint"))
    picked = spark.sparkContext.broadcast(filter_of(common))
    active = materialize(named_texts.mapInArrow(
        _active(k, threshold, shared, picked, with_text),
        f"id {id_type}, s1 bigint, s2 bigint, {'text string, ' if with_text else ''}n int, grams array<bigint>, places array<int>, "
        + ", ".join(f"{c} bigint" for c in _PACKED)), "jaccard-active")
    shared.destroy()
    picked.destroy()
    return members, standing, active


def near_groups(docs: DataFrame, k: int = 4, threshold: Fraction = Fraction(85, 100), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of each row: documents linked by a Jaccard likeness of at least ``threshold``.

    A document's set holds its distinct runs of ``k`` words; a shorter one has its whole sequence as one, one without
    words has none and is linked with nothing. ``component_id`` is the smallest id reachable over links, its own
    included. Rows without id are left alone: their component is null. Rows with the same id are one node with the
    links of each of its texts.
    """
    members, standing, active = _prepare(docs, k, threshold, id_col, text_col, with_text=False)
    texts = keyed(docs, id_col, text_col).select("id", "text").where("id IS NOT NULL")  # read again, not written
    shares = materialize(
        active.join(standing.where("id = rep"), ["id", "s1", "s2"], "left_semi")
        .select("id", "n", F.explode(F.arrays_zip("grams", "places")).alias("g"), *_PACKED)
        .select(F.col("g.grams").alias("gram"), "id", "n", F.col("g.places").alias("pos"), *_PACKED), "jaccard-shares")

    row = F.struct("id", "n", "pos", *_PACKED)
    by_gram = _by_gram(shares)  # one shuffle for the leaders and for those who meet them
    leaders = by_gram.groupBy("gram").agg(
        F.array_distinct(F.array(F.min_by(row, "id"), F.min_by(row, F.struct("n", "id")), F.max_by(row, F.struct("n", "id")))).alias("leaders"),
        F.count("*").alias("size")).where("size > 1").select("gram", F.explode("leaders").alias("l")).select("gram", "l.*")
    met = by_gram.join(_other(leaders), "gram")

    first = materialize(in_few_files(_closest(met, threshold)), "jaccard-pairs")
    links = materialize(_verify(first, texts, k, threshold), "jaccard-links")
    grouped = materialize(in_few_files(components(links)), "jaccard-groups")

    tested, remaining = first, shares
    for last in (False, True):
        # n-grams whose documents are in different components still: other leaders first, then all pairs across
        placed = remaining.join(grouped, F.col("id") == F.col("node"), "left").withColumn("own", F.coalesce("component", "id"))
        open_grams = placed.groupBy("gram").agg(F.min("own").alias("low"), F.max("own").alias("high")).where("low <> high")
        # a closed n-gram that passes the filter brings no pair across
        open_shares = materialize(_passing(placed.select(*shares.columns, "own"), F.col("gram"), open_grams.select(F.col("gram").alias("h"))),
                                  "jaccard-open")
        release(remaining)
        remaining = open_shares.drop("own")  # components only grow, so an n-gram that is not open stays so
        by_gram = other = _by_gram(open_shares)
        if not last:
            row = F.struct(*[c for c in open_shares.columns if c != "gram"])
            ends = F.array(F.min_by(row, F.xxhash64("id")), F.max_by(row, F.xxhash64("id")))
            other = by_gram.groupBy("gram").agg(ends.alias("l")).select("gram", F.explode(F.array_distinct("l")).alias("l")).select("gram", "l.*")
        across = by_gram.join(_other(other), "gram").where(F.col("own") != F.col("other_own"))
        if last:
            rest = _candidates(across.where(F.col("id") > F.col("other")), threshold)
        else:
            rest = _closest(across, threshold)
        rest = materialize(in_few_files(rest.join(tested, ["a", "b"], "left_anti")), "jaccard-pairs")
        more = materialize(_verify(rest, texts, k, threshold), "jaccard-links")
        if not last:
            tested = tested.unionByName(rest)
            stars = grouped.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")
            grouped = materialize(in_few_files(components(stars.unionByName(more))), "jaccard-groups")

    release(active, remaining)
    copies = standing.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    every = components(grouped.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")
                       .unionByName(more.select("a", "b")).unionByName(copies))
    return (members.join(every, F.col("id") == F.col("node"), "left")
            .select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))


#: Documents of one n-gram and one length that meet in one task.
BLOCK = 2000


def near_links(docs: DataFrame, k: int = 4, threshold: Fraction = Fraction(85, 100), id_col: str = "doc_id",
               text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every link: (a, b, rep_a, rep_b, n_links) of classes, and their members (id, class, rep).

    Documents with equal sets are a class, named by (s1, s2) of the set; ``rep`` is its smallest id. There is one row for
    each two classes whose sets have a Jaccard likeness of at least ``threshold``, and ``n_links`` is the number of pairs
    of documents that it stands for. All documents of a class are linked with one another too; ``count_links`` counts
    them. A document without id or words is in no class. Rows with the same id and set are one document, an id with
    several sets is a document for each.
    """
    _, standing, active = _prepare(docs, k, threshold, id_col, text_col)
    kind = F.struct("s1", "s2").alias("class")
    members = standing.select("id", kind, "rep").distinct()
    ones = standing.where("id = rep").select("id", "s1", "s2").distinct()
    reps = active.dropDuplicates(["id", "s1", "s2"]).join(ones, ["id", "s1", "s2"])
    reps = materialize(reps.select(kind, "text", "n", "grams", "places", *_PACKED).withColumnRenamed("class", "id"), "jaccard-classes")
    shares = reps.select("id", "n", F.explode(F.arrays_zip("grams", "places")).alias("g"), *_PACKED).select(
        F.col("g.grams").alias("gram"), "id", "n", F.col("g.places").alias("pos"), *_PACKED)
    # sets that link are of one length class or of neighbouring ones; the larger one stays where it is
    size = F.col("n").cast("bigint")
    if threshold < 1:
        size = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold))
    larger = materialize(shares.withColumn("size", size), "jaccard-shares")
    crowded = (larger.groupBy("gram", "size").count().where(F.col("count") > BLOCK)
               .select("gram", "size", F.ceil(F.col("count") / BLOCK).alias("blocks")))
    smaller = larger.withColumn("size", F.explode(F.array(*[F.col("size") + i for i in range(3)])))

    def dealt(rows: DataFrame, block) -> DataFrame:
        return (rows.join(F.broadcast(crowded), ["gram", "size"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
                .withColumn("block", block).drop("blocks"))

    # crowded n-grams are cut into blocks: the larger set of a pair is in one of them, the smaller one in all
    left = dealt(larger, F.pmod(F.xxhash64("id", "gram"), F.col("blocks")))
    right = dealt(smaller, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    other = right.select("gram", "size", "block", *[F.col(c).alias("other" if c == "id" else f"other_{c}")
                                                    for c in shares.columns if c != "gram"])
    met = left.join(other, ["gram", "size", "block"]).where(F.struct("n", "id") > F.struct("other_n", "other"))
    pairs = materialize(_candidates(met, threshold), "jaccard-pairs")
    linked = materialize(_verify(pairs, reps.select("id", "text"), k, threshold), "jaccard-links")
    sizes = members.groupBy("class", "rep").agg(F.count("*").alias("size"))
    for side in ("a", "b"):
        linked = linked.join(sizes.select(F.col("class").alias(side), F.col("rep").alias(f"rep_{side}"),
                                          F.col("size").alias(f"size_{side}")), side)
    links = linked.select("a", "b", "rep_a", "rep_b", (F.col("size_a") * F.col("size_b")).alias("n_links"))
    return links, members


def count_links(links: DataFrame, members: DataFrame) -> int:
    """The number of linked pairs of documents: those between classes, and all pairs inside each."""
    between = links.agg(F.sum("n_links")).first()[0] or 0
    sizes = members.groupBy("class").agg(F.count("*").cast("decimal(38,0)").alias("n"))
    return int(between) + int(sizes.agg(F.sum(F.expr("n * (n - 1)"))).first()[0] or 0) // 2


def _by_gram(shares: DataFrame) -> DataFrame:
    """``shares`` shuffled by n-gram. Nothing in them is null; where that is said, all readers share one shuffle, as none
    of them filters nulls before it."""
    return shares.where(reduce(and_, [F.col(c).isNotNull() for c in shares.columns])).repartition("gram")


def _other(shares: DataFrame) -> DataFrame:
    """The other side of a join by n-gram: all columns but the n-gram under new names."""
    return shares.select("gram", *[F.col(c).alias("other" if c == "id" else f"other_{c}") for c in shares.columns if c != "gram"])


def _candidates(met: DataFrame, t: Fraction) -> DataFrame:
    """Distinct pairs (a, b), a the larger id, that pass all filters, from all pairs of each n-gram."""
    return (met.where((F.col("id") != F.col("other")) & _may_link(t, first=True) & _suffix_may_link(t))
            .select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")).distinct())


def _closest(met: DataFrame, t: Fraction) -> DataFrame:
    """For each document the pair (a, b), a the larger id, with the least difference, of those that pass the filters."""
    best = (met.where((F.col("id") != F.col("other")) & _may_link(t) & _suffix_may_link(t))
            .groupBy("id").agg(F.min(F.struct(_apart().alias("apart"), "other")).alias("best")))
    return best.select(F.greatest("id", "best.other").alias("a"), F.least("id", "best.other").alias("b")).distinct()
