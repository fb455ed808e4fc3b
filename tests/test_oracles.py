"""Every query against the SQL that states the same result, over the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as job

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
ORACLES = job.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5)
    return value


def canonical(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", list(job.queries()))
def test_query(spark, duck, name):
    frame = job.queries()[name](spark, FOLDER)
    got = frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    want = result.fetchall()
    assert sorted(frame.columns) == sorted(names)
    assert canonical(frame.columns, got) == canonical(names, want)


def test_entry(spark):
    assert job.entry(spark).count() > 0
