"""Slim rows, such as edges, are written to few files however many partitions a shuffle has."""

from tablekit.llm.components import components


def test_rounds_write_few_files(spark):
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        edges = spark.range(600).selectExpr("id AS a", "id - id % 3 AS b")
        found = components(edges)
        assert {r["node"]: r["component"] for r in found.collect()} == {i: i - i % 3 for i in range(600)}
        assert len(found.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
