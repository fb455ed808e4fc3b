"""Listings in tasks, counts of many tables, bulk descriptions, registration of partitions."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tablekit.operators import counting, registering
from tablekit.operators import lifecycle as life
from tablekit.sources import catalog, listing


def touch(path, text="x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


def test_hidden_names_empty_and_missing_directories(spark, tmp_path):
    for name in ("a.txt", "_x", ".x", "sub/_y/deep.txt", "sub/b c%20é.txt"):
        touch(f"{tmp_path}/r/{name}", name)
    os.makedirs(f"{tmp_path}/r/empty")
    os.symlink(f"{tmp_path}/r", f"{tmp_path}/r/empty/loop")
    found = listing.list_entries(spark, [f"{tmp_path}/r", f"{tmp_path}/none"])
    assert {r["rel_path"]: (r["length"], r["is_dir"]) for r in found.where("not is_dir and rel_path not like '%/loop'").collect()} == {
        n: (len(n.encode()), False) for n in ("a.txt", "_x", ".x", "sub/_y/deep.txt", "sub/b c%20é.txt")}
    assert {r["rel_path"] for r in found.where("is_dir").collect()} == {"sub", "sub/_y", "empty"}
    assert listing.inventory(spark, f"file:{tmp_path}/r").count() == 6
    assert rows(listing.partition_directories(found.withColumn("rel_path", F.lit("y=1/m=2")).withColumn("is_dir", F.lit(True)), 2).distinct(),
                "spec") == [("y=1/m=2",)]


def test_no_level_is_listed_by_one_task(spark, tmp_path, monkeypatch):
    for i in range(40):
        os.makedirs(f"{tmp_path}/r/d{i}/e")
    tasks = []
    plain = listing.materialize
    monkeypatch.setattr(listing, "materialize", lambda df, label: tasks.append(df.rdd.getNumPartitions()) or plain(df, label))
    assert listing.list_entries(spark, [f"{tmp_path}/r"], width=6).count() == 80
    assert tasks == [6, 6, 6]


def trees(spark, tmp_path):
    data = spark.range(100).select("id", (F.col("id") % 4).cast("string").alias("p"))
    data.write.partitionBy("p").parquet(f"{tmp_path}/one")
    data.where("id < 10").write.orc(f"{tmp_path}/two words")
    data.where("id < 7").write.parquet(f"{tmp_path}/one/nested_table")  # a table inside another one's folder
    os.makedirs(f"{tmp_path}/none")
    places = [("one", "one", "parquet"), ("two", "two words", "ORC"), ("nested", "one/nested_table", "parquet"), ("none", "none", "parquet")]
    return spark.createDataFrame([(n, f"{tmp_path}/{p}", f) for n, p, f in places], "table_name string, location string, format string")


def test_counts_of_many_tables(spark, tmp_path):
    tables = trees(spark, tmp_path)
    assert rows(counting.count_locations(spark, tables)) == [("nested", 7), ("none", 0), ("one", 100), ("two", 10)]


def test_scans_do_not_grow_with_tables(spark, tmp_path):
    def scans(n):
        paths = []
        for i in range(n):
            paths.append(f"{tmp_path}/n{n}/t{i}")
            spark.range(i + 1).write.parquet(paths[-1])
        tables = spark.createDataFrame([(str(i), p, "parquet") for i, p in enumerate(paths)], "table_name string, location string, format string")
        counts = counting.count_locations(spark, tables)
        assert {r["table_name"]: r["row_count"] for r in counts.collect()} == {str(i): i + 1 for i in range(n)}
        return counts._jdf.queryExecution().executedPlan().toString().count("FileScan")

    assert scans(2) == scans(9)


def test_counts_of_selected_partitions(spark, tmp_path):
    tables = trees(spark, tmp_path).where("table_name <> 'two'")
    chosen = spark.createDataFrame([("one", "p=1"), ("one", "p=3"), ("one", "p=gone"), ("one", "p=1")], "table_name string, spec string")
    assert rows(counting.count_selected(spark, tables, chosen)) == [("nested", 0), ("none", 0), ("one", 50)]


def test_descriptions_take_one_statement_a_database(spark, db, tmp_path, monkeypatch):
    spark.sql(f"CREATE TABLE {db}.a (id INT, y STRING, `odd,name` STRING) USING parquet PARTITIONED BY (y, `odd,name`) LOCATION '{tmp_path}/a'")
    spark.sql(f"CREATE TABLE {db}.b (id INT) USING orc LOCATION '{tmp_path}/b'")
    spark.sql(f"CREATE VIEW {db}.v AS SELECT 1 AS x")
    asked = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: asked.append(text) or sql(self, text, *a, **k))
    found = {r["tbl"]: r for r in catalog.describe_tables(spark, [db, "no_such_db"]).collect()}
    assert len(asked) == 1
    assert {t: (r["format"], r["table_type"]) for t, r in found.items()} == {
        "a": ("PARQUET", "EXTERNAL"), "b": ("ORC", "EXTERNAL"), "v": ("VIEW", "VIEW")}
    assert found["a"]["partition_columns"][0] == "y" and found["b"]["partition_columns"] == []
    assert found["a"]["location"].endswith("/a") and found["v"]["location"] is None
    assert catalog.describe_tables(spark, []).count() == 0


def test_partition_statements(spark, db, tmp_path):
    odd = ["plain", "it's", "back\\slash", "a/b", "50%", None]
    data = spark.createDataFrame([(i, v) for i, v in enumerate(odd)], "id int, p string")
    data.write.partitionBy("p").parquet(f"{tmp_path}/t")
    spark.sql(life.external_ddl(db, "t", [("id", "int")], [("p", "string")], f"{tmp_path}/t"))
    spark.sql(f"ALTER TABLE {db}.t ADD PARTITION (p = 'stale') LOCATION '{tmp_path}/stale'")
    found = listing.list_entries(spark, [f"{tmp_path}/t"])
    wanted = listing.partition_directories(found, 1).select(F.lit(db).alias("db"), F.lit("t").alias("tbl"), "spec")
    tables = spark.createDataFrame([(db, "t", f"{tmp_path}/t")], "db string, tbl string, location string")
    done = registering.set_partitions(spark, tables, wanted).first()
    assert (done["added"], done["dropped"], done["kept"], done["error"]) == (6, 1, 0, None)
    assert rows(spark.table(f"{db}.t"), "id", "p") == [(i, v) for i, v in enumerate(odd)]
    again = registering.set_partitions(spark, tables, wanted).first()
    assert (again["added"], again["dropped"], again["kept"]) == (0, 0, 6)


def test_statements_hold_a_bounded_number_of_partitions(spark):
    changes = spark.range(2000).select(F.lit("d").alias("db"), F.lit("t").alias("tbl"), F.concat(F.lit("p="), F.col("id").cast("string")).alias("spec"),
                                       F.lit("ADD").alias("change"))
    tables = spark.createDataFrame([("d", "t", "/x")], "db string, tbl string, location string")
    texts = [r["statement"] for r in registering.partition_statements(changes, tables, batch=100).collect()]
    assert sum(t.count("PARTITION (") for t in texts) == 2000 and max(t.count("PARTITION (") for t in texts) < 200


def test_a_failing_table_does_not_stop_the_others(spark, db, tmp_path):
    spark.range(3).withColumn("p", F.lit("a")).write.partitionBy("p").parquet(f"{tmp_path}/good")
    columns, keys = [("id", "bigint")], [("p", "string")]
    specs = spark.createDataFrame([(db, "good", f"{tmp_path}/good", "parquet", columns, keys), (db, "bad", f"{tmp_path}/no", "parquet", None, keys)],
                                  "db string, tbl string, location string, format string, columns array<struct<name:string,type:string>>, "
                                  "partition_columns array<struct<name:string,type:string>>")
    done = {r["tbl"]: r for r in registering.register_tables(spark, specs).collect()}
    assert done["good"]["status"] == "COMPLETED" and spark.table(f"{db}.good").count() == 3
    assert done["bad"]["status"] == "FAILED" and "PATH_NOT_FOUND" in done["bad"]["error"]


@pytest.mark.parametrize("here,there,decision", [("s3a://b/t", "s3://b/t/", "REPAIR"), ("s3a://b/t", "s3a://c/t", "REFUSE"), ("file:/x/t", "/x/t", "REPAIR")])
def test_places_are_compared_with_their_store(spark, here, there, decision):
    from tablekit.functions.paths import local_path

    frame = spark.createDataFrame([(here, there)], "here string, there string")
    got = frame.select(life.creation_decision(F.lit(True), F.lit(False), F.lit("PARQUET"), local_path("here"), local_path("there"))["decision"])
    assert got.first()[0] == decision
