"""Merkle manifest of a dataset: a tree of digests per source, and one over the sources.

Only every STEP-th level of nodes is written. A block, the RUN ** STEP nodes of a written level below one node of the
next, is never more than one small group, however large its source. Proofs go down the written levels: each block's
missing levels are made again from its nodes, give the siblings on the way, and are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.session import materialize

RUN = 3
STEP = 5
BLOCK = RUN ** STEP

#: Siblings level by level: the digests of a run, as text, to the left and to the right of the node on the way.
PATH = "array<struct<left: string, right: string>>"
_PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def field(c: Column) -> Column:
    """A value as it goes into a leaf: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _digest(texts: Iterable[str]) -> str:
    return sha256("".join(texts).encode()).hexdigest()


def _levels(digests: list[str], nodes: int) -> list[list[str]]:
    """The levels above a block of a tree that has ``nodes`` nodes at this level: STEP of them, or up to its top."""
    out = [digests]
    while len(out) <= STEP and (nodes > BLOCK or len(out[-1]) > 1):
        low = out[-1]
        out.append([_digest(low[i:i + RUN]) for i in range(0, len(low), RUN)])
    return out


def _in_order(nodes: pa.Table) -> tuple[pa.Table, list[str]]:
    nodes = nodes.sort_by("pos")
    return nodes, [d.hex() for d in nodes.column("digest").to_pylist()]


def _fold(nodes: pa.Table) -> pa.Table:
    nodes, digests = _in_order(nodes)
    count = nodes.column("nodes")[0].as_py()
    top = _levels(digests, count)[-1][0]
    return pa.table({"tree": nodes.column("tree")[:1], "pos": nodes.column("block")[:1],
                     "digest": pa.array([bytes.fromhex(top)], pa.binary()),
                     "nodes": pa.array([-(-count // BLOCK)], pa.int64()),
                     "done": pa.array([count <= BLOCK])})


def _prove(nodes: pa.Table, above: pa.Table) -> pa.Table:
    nodes, digests = _in_order(nodes)
    levels = _levels(digests, nodes.column("nodes")[0].as_py())[:-1]
    rest = above.column("path")[0].as_py()
    left, right, ends = [], [], [0]
    for place in range(len(digests)):
        for low in levels:
            start = place - place % RUN
            left.append("".join(low[start:place]))
            right.append("".join(low[place + 1:start + RUN]))
            place //= RUN
        left += [r["left"] for r in rest]
        right += [r["right"] for r in rest]
        ends.append(len(left))
    steps = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"])
    out = nodes.select(["tree", "pos", "carry"]).append_column(
        "path", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps).cast(_PATH_TYPE))
    for name in ("subroot", "root"):
        out = out.append_column(name, pa.chunked_array([pa.array([above.column(name)[0].as_py()] * len(digests), pa.string())]))
    return out


@dataclass
class Manifest:
    """Written levels of every tree, lowest first: (tree, pos, digest, nodes, carry, block); and the tops of the trees."""

    levels: list[DataFrame]
    tops: DataFrame  # (tree, digest)


def _numbered(nodes: DataFrame) -> DataFrame:
    """(tree, id, digest, carry) with ``pos``, the place by id in the tree, and ``nodes``, the size of the tree.

    Rows are dealt out and sorted by (tree, id, digest); what is added up are the sizes of the trees' shares of a range.
    """
    tied = materialize(nodes.withColumn("tie", F.monotonically_increasing_id()), "merkle-leaves")
    order = [F.col("tree"), F.col("id").asc_nulls_first(), F.col("digest"), F.col("tie")]
    ranged = materialize(tied.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("at", F.monotonically_increasing_id()), "merkle-ranges")
    part = F.shiftright("at", 33)
    shares = ranged.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = shares.select(F.col("tree").alias("own"), F.col("part").alias("own_part"), "first",
                           F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
                           F.sum("rows").over(Window.partitionBy("tree")).alias("nodes"))
    return (ranged.join(starts, (F.col("tree") == F.col("own")) & (part == F.col("own_part")))
            .select("tree", (F.col("start") + F.col("at") - F.col("first")).alias("pos"), "digest", "nodes", "carry"))


def _blocked(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))


def build(nodes: DataFrame) -> Manifest:
    """The trees over (tree, id, digest, carry): digests as 32 bytes, ``carry`` any struct that goes with a node.

    Nodes ascend by id, null ids first, equal ids by digest. Every STEP-th level is written until all trees have one
    node left.
    """
    level = materialize(_blocked(_numbered(nodes)), "merkle-level")
    levels, tops = [level], None
    while True:
        folded = level.select("tree", "pos", "digest", "nodes", "block").groupBy("tree", "block").applyInArrow(
            _fold, "tree string, pos long, digest binary, nodes long, done boolean")
        folded = materialize(folded, "merkle-level")
        done = folded.where("done").select("tree", "digest")
        tops = done if tops is None else tops.unionByName(done)
        rest = folded.where("not done")
        if rest.isEmpty():
            return Manifest(levels, tops)
        level = _blocked(rest.select("tree", "pos", "digest", "nodes", F.struct("pos").alias("carry")))
        levels.append(level)


def prove(manifest: Manifest, above: DataFrame) -> DataFrame:
    """(tree, pos, carry, path, subroot, root) of every leaf.

    ``above`` has (tree, path, subroot, root) of every top. Blocks meet the one proof of their parent, so no group has
    more than BLOCK rows.
    """
    found = None
    for level in reversed(manifest.levels):
        parents = (level.where(f"block = 0 and nodes <= {BLOCK}").select(F.col("tree").alias("own")).distinct()
                   .join(above, F.col("own") == F.col("tree")).select("tree", F.lit(0).cast("long").alias("block"),
                                                                      "path", "subroot", "root"))
        if found is not None:
            parents = parents.unionByName(found.select("tree", F.col("pos").alias("block"), "path", "subroot", "root"))
        carry = level.schema["carry"].dataType.simpleString()
        found = level.groupBy("tree", "block").cogroup(parents.groupBy("tree", "block")).applyInArrow(
            _prove, f"tree string, pos long, carry {carry}, path {PATH}, subroot string, root string")
    return found


def tree_name(source: Column) -> Column:
    """A source as the name of its tree, null first and otherwise in the order of its bytes."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def manifest_proofs(leaves: DataFrame) -> DataFrame:
    """(carry, path, subroot, root) of every row of (source, id, leaf, carry), leaf as hexadecimal text.

    A tree per source, its leaves ascending by id; nodes are joined three by three, the last run as it is, until one is
    left. The subroots, by source, null first, are the leaves of the tree that ends in the root. Null ids come first;
    rows with the same id are in the order of their leaves, so equal rows may change places with one another. A single
    leaf is its own subroot, a single subroot the root; their paths have no steps. An empty table gives an empty result.
    """
    trees = build(leaves.select(tree_name(F.col("source")).alias("tree"), "id", F.unhex("leaf").alias("digest"), "carry"))
    tops = materialize(trees.tops, "merkle-tops")
    over = build(tops.select(F.lit("").alias("tree"), F.col("tree").alias("id"), "digest",
                             F.struct("tree", F.lower(F.hex("digest")).alias("subroot")).alias("carry")))
    root = over.tops.first()
    end = tops.select(F.lit("").alias("tree"), F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"),
                      F.lit(root["digest"].hex() if root else "").alias("root")).limit(1)
    above = materialize(prove(over, end).select(F.col("carry.tree").alias("tree"), "path",
                                                F.col("carry.subroot").alias("subroot"), "root"), "merkle-above")
    return prove(trees, above).select("carry", "path", "subroot", "root")


def proof_digest(path: str) -> Column:
    """The digest of all siblings on a path, left to right, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: str) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def document_proofs(docs: DataFrame, changed_text: Column | None = None, id_col: str = "doc_id",
                    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                    source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, leaf, changed, path, subroot, root) of every document.

    A leaf is the digest of ``columns``, a null as ``-``. ``changed`` is the leaf with ``changed_text`` in place of the
    text (the same as ``leaf`` without it). Texts of any length are hashed in the scan; only digests are shuffled.
    """
    own = {c: docs[f"`{c}`"] for c in columns}
    text = docs[text_col] if changed_text is None else changed_text
    leaves = docs.select(docs[source_col].alias("source"), docs[id_col].alias("id"), leaf_digest(own.values()).alias("leaf"),
                         leaf_digest([text if c == text_col else v for c, v in own.items()]).alias("changed"))
    carried = leaves.select("source", "id", "leaf", F.struct(
        "id", F.unhex("leaf").alias("leaf"), F.when(F.col("changed") != F.col("leaf"), F.unhex("changed")).alias("changed")
    ).alias("carry"))
    hexed = {c: F.lower(F.hex(F.col("carry")[c])) for c in ("leaf", "changed")}
    return manifest_proofs(carried).select(
        F.col("carry.id").alias("id"), hexed["leaf"].alias("leaf"), F.coalesce(hexed["changed"], hexed["leaf"]).alias("changed"),
        "path", "subroot", "root")
