import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tablekit.operators import ordered


@pytest.mark.parametrize("chunk", [1, 3, 7, 1000])
def test_carry_forward_is_a_plain_fill(spark, chunk):
    rng = random.Random(7)
    data = [(g, i, rng.choice([None, None, f"v{i}"])) for g in ("a", "b") for i in range(60)]
    frame = spark.createDataFrame(data, "g string, i long, v string")
    value = F.when(F.col("v").isNotNull(), F.struct(F.col("i").alias("at"), F.col("v").alias("v")))
    got = {(r["g"], r["i"]): r["f"] and r["f"]["v"] for r in ordered.carry_forward(frame, ["g"], "i", {"f": value}, chunk).collect()}
    want, last = {}, {}
    for g, i, v in data:
        last[g] = v or last.get(g)
        want[g, i] = last[g]
    assert got == want


def test_top_n_of_a_hot_group(spark):
    frame = spark.range(2000).select(F.when(F.col("id") < 1500, "hot").otherwise("cold").alias("k"), "id")
    got = rows(ordered.top_n(frame, ["k"], [F.col("id").desc()], 3), "k", "id")
    assert got == [("cold", 1997), ("cold", 1998), ("cold", 1999), ("hot", 1497), ("hot", 1498), ("hot", 1499)]


def test_number_rows(spark):
    frame = spark.range(500).select((F.col("id") % 7).alias("size"), "id")
    bins = [-F.col("size"), F.floor(F.col("id") / 100)]
    out = ordered.number_rows(frame, bins, [F.col("size").desc(), F.col("id")], "rank")
    want = sorted(((i % 7, i) for i in range(500)), key=lambda x: (-x[0], x[1]))
    assert [(r["size"], r["id"]) for r in out.orderBy("rank").collect()] == want
    assert [r["rank"] for r in out.orderBy("rank").collect()] == list(range(500))


def test_text_lists_go_on_in_parts(spark):
    frame = spark.range(100).select(F.lit("k").alias("k"), F.concat(F.lit("v"), F.col("id")).alias("v"))
    out = ordered.text_lists(frame.union(frame), ["k"], ["v"], part_size=30).collect()
    assert {r["parts"] for r in out} == {4} and sorted(r["part"] for r in out) == [0, 1, 2, 3]
    entries = [v for r in out for v in r["v"].split(", ")]
    assert sorted(entries) == sorted(f"v{i}" for i in range(100))
    assert rows(ordered.text_lists(frame.limit(2), ["k"], ["v"]), "part", "parts", "v") == [(0, 1, "v0, v1")]


def test_latest_and_earliest(spark):
    frame = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", 5, "y")], "k string, n int, v string")
    assert rows(ordered.latest(frame, ["k"], [F.col("n")])) == [("a", 2, "x"), ("b", 5, "y")]
    assert rows(ordered.earliest(frame, ["k"], [F.col("n")])) == [("a", 1, None), ("b", 5, "y")]


def test_salted_join_is_a_plain_join(spark):
    big = spark.range(1000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id") % 5).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k int, v string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(ordered.salted_join(big, small, ["k"], how, salts=4)) == rows(big.join(small, ["k"], how))
