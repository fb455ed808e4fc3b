"""The manifest and its proofs against a tree held in memory."""

import hashlib
import random
import zlib

import pytest
from conftest import make
from pyspark.sql import functions as F

from tablekit.llm import merkle


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    return h(*[field(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")])


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[i:i + 3]) for i in range(0, len(low), 3)])
    return levels


def siblings(levels, place):
    out = []
    for low in levels[:-1]:
        start = place - place % 3
        out.append(("".join(low[start:place]), "".join(low[place + 1:start + 3])))
        place //= 3
    return out


def plain(rows):
    """(doc_id, leaf, subroot, root, siblings of every level) of every row."""
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in by[s]])
    top = tree([trees[s][-1][0] for s in names])
    return sorted((r["doc_id"], leaf(r), trees[s][-1][0], top[-1][0], siblings(trees[s], i) + siblings(top, k))
                  for k, s in enumerate(names) for i, r in enumerate(by[s]) if r["doc_id"] is not None)


def check(docs):
    rows = docs.collect()
    got = merkle.document_proofs(docs).collect()
    assert len(got) == len(rows)
    assert sorted((r["id"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]])
                  for r in got if r["id"] is not None) == plain(rows)


def test_odd_rows(spark, odd):
    check(odd)


def test_several_written_levels_and_many_sources(spark):
    rng = random.Random(1)
    rows = [(i, f"text {i}\n", "big") for i in range(800)] + [(1000 + i, "x", f"s{i}") for i in range(300)]
    rows += [(5000 + i, None, None) for i in range(244)]
    rng.shuffle(rows)
    check(make(spark, rows))


def test_null_and_repeated_ids(spark):
    rows = [(None, f"t{i % 2}", "a") for i in range(9)] + [(3, "same", "a")] * 4 + [(1, "", "a")]
    docs = make(spark, rows)
    got = merkle.document_proofs(docs).withColumn("end", merkle.folded(F.col("leaf"), "path")).collect()
    want = plain(docs.collect())
    assert {r["root"] for r in got} == {r["end"] for r in got} == {want[0][3]}
    assert sorted((r["id"], r["leaf"], [tuple(s) for s in r["path"]]) for r in got if r["id"] is not None) == sorted(
        (w[0], w[1], w[4]) for w in want)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 243])
def test_one_source(spark, count):
    docs = make(spark, [(i, str(i), "only") for i in range(count)])
    check(docs)
    if count == 1:
        row = merkle.document_proofs(docs).select("*", merkle.proof_digest("path").alias("p")).first()
        assert row["leaf"] == row["subroot"] == row["root"] and row["path"] == [] and row["p"] == h("")


def test_empty_table(spark, empty):
    assert merkle.document_proofs(empty).collect() == []


def test_changed_texts_are_found(spark):
    odd = make(spark, [(i, ["one\ntwo", "none", None, "\n", ""][i % 5], f"s{i % 3}") for i in range(60)])
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    got = merkle.document_proofs(odd, changed).withColumn("end", merkle.folded(F.col("changed"), "path")).collect()
    lost = {r["doc_id"] for r in odd.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in (r["text"] or "")}
    assert lost and {r["id"] for r in got if r["end"] != r["root"]} == lost


def test_only_every_few_levels_are_written(spark):
    leaves = make(spark, [(i, str(i), "one") for i in range(250)]).select(
        F.lit("one").alias("tree"), F.col("doc_id").alias("id"), F.unhex(F.sha2("text", 256)).alias("digest"),
        F.struct("doc_id").alias("carry"))
    built = merkle.build(leaves)
    assert [level.count() for level in built.levels] == [250, 2]
    assert built.tops.count() == 1
