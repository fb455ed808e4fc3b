"""Rows without ids, ids that are texts or far apart, and fingerprints against a plain version."""

import random
import struct

import pytest
import xxhash
from made_words import words
from pyspark.sql import functions as F

from tablekit.llm import line_dedup, order_minhash


def test_rows_without_id_lose_lines_of_their_own_text_only(spark):
    rows = [(3, "a shared line\nthe line of three"), (None, "a shared line\nthe line of one without"), (None, "the line of three\nmine alone, no other"),
            (None, "a shared line\nthe line of one without"), (7, "The Line Of One Without\nshort\nshort"), (3, "another text of three\na shared line")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r["id"], r["row"]["text"], r["kept"]) for r in line_dedup.dedup_lines(docs).collect()), key=repr)
    keep = {"a shared line": 3, "the line of three": 3, "the line of one without": 7}

    def left(i, text):
        return "\n".join(x for x in text.split("\n") if keep.get(x.lower(), i) == i)

    assert got == sorted(((i, t, left(i, t)) for i, t in rows), key=repr)


def test_a_hot_line_among_many(spark):
    rows = [(i, f"the one hot line\nline of {i // 2} and its twin") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    done = line_dedup.dedup_lines(docs).agg(F.sum("n_dropped").alias("n"), F.count_if(F.col("kept") == "").alias("none")).first()
    assert (done["n"], done["none"]) == (2999 + 1500, 1500)


def edited(text, following):
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_the_next_document_by_texts_and_by_ids_far_apart(spark, kind):
    rng = random.Random(3)
    ids = [rng.getrandbits(60) - (1 << 59) for _ in range(150)]
    rows = [(str(i) if kind == "string" else i, words(rng, rng.randint(0, 12))) for i in ids] + [(None, "the last text of all")]
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string")
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or (0 if kind == "bigint" else "")))
    want = sorted(((i, edited(t, order[(k + 1) % len(order)][1])) for k, (i, t) in enumerate(order)), key=repr)
    assert sorted(((r["id"], r["edited"]) for r in order_minhash.edit_probe(docs).collect()), key=repr) == want


def test_no_task_orders_all_ids(spark):
    ids = spark.range(4000).select((F.xxhash64("id") * 1).alias("bucket"))
    found = order_minhash._previous(ids).collect()
    order = sorted(r["bucket"] for r in found)
    assert {r["bucket"]: r["previous"] for r in found} == {b: order[k - 1] for k, b in enumerate(order)}


def chained(*values):
    """Spark's xxhash64: each value is hashed with the hash of those before it as the seed."""
    seed = 42
    for kind, v in values:
        data = v.encode() if kind == "s" else struct.pack("<q" if kind == "l" else "<i", v)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_signature(text, k=3, chosen=2):
    hashed = [chained(("s", w)) for w in text.split()]
    count = max(len(hashed) - k + 1, min(len(hashed), 1))
    mask = (1 << 33) - 1
    runs = sorted((chained(*[("l", x) for x in hashed[i:i + k]]) & mask, i) for i in range(count))
    seen, numbered = {}, []
    for h, place in runs:
        numbered.append((chained(("l", h), ("i", seen.get(h, 0))) & mask, place))
        seen[h] = seen.get(h, 0) + 1
    bins = {}
    for h, place in sorted(numbered):
        mine = bins.setdefault(h >> 27, [])
        if len(mine) < chosen:
            mine.append((place, h))
    return [b << 40 | (chained(*[("l", h) for _, h in sorted(mine)]) & ((1 << 40) - 1)) for b, mine in sorted(bins.items())]


def test_fingerprints_against_a_plain_version(spark):
    rng = random.Random(4)
    texts = ["", "one", "one two", "a b c", "a b c a b c a b c", words(rng, 40), words(rng, 400), "x " * 90, words(rng, 3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["id"]: r["signature"] for r in order_minhash.fingerprints(docs).collect()}
    assert got == {i: plain_signature(t) for i, t in enumerate(texts)}
