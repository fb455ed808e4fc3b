import os
import shutil

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tablekit.operators import lifecycle as life
from tablekit.operators import partitions as parts
from tablekit.sources import catalog, files


def is_parquet(spark):
    def check(name):
        found = spark.sql(f"DESCRIBE FORMATTED {name}").where("lower(col_name) = 'provider'").first()
        return bool(found) and found["data_type"].lower() == "parquet"
    return check


@pytest.fixture
def sales(spark, tmp_path):
    """Three partitions of data and one empty directory."""
    path = str(tmp_path / "sales")
    data = spark.createDataFrame([(i, f"c{i}", 1.5 * i, 2023 + i % 2, "01" if i < 5 else "12") for i in range(10)],
                                 "order_id int, customer string, amount double, year int, month string")
    data.write.partitionBy("year", "month").parquet(path)
    os.makedirs(f"{path}/year=2025/month=01")
    return path


def test_register_parquet(spark, db, sales):
    row = life.register_parquet(spark, db, "sales", sales).first()
    assert (row["status"], row["table_rows"], row["file_rows"], row["registered_partitions"], row["written_partitions"]) == ("VALIDATED", 10, 10, 5, 4)
    assert life.register_parquet(spark, db, "sales", sales).first()["status"] == "VALIDATED"
    assert life.register_parquet(spark, db, "sales", sales + "/year=2023").first()["status"] == "SKIPPED"
    assert rows(files.registered_directories(spark, f"{db}.sales"))[-1] == ("year=2025/month=01",)
    assert {c["name"]: c["type"] for c in catalog.columns(spark, db, ["sales"]).collect()}["month"] == "string"


def test_register_external(spark, db, sales, tmp_path):
    cols = spark.createDataFrame([
        (db, "sales", 0, "order_id", "int", False), (db, "sales", 1, "customer", "string", False), (db, "sales", 2, "amount", "double", False),
        (db, "sales", 3, "year", "int", True), (db, "sales", 4, "month", "string", True)],
        "db string, tbl string, pos int, name string, type string, is_partition boolean")
    tables = spark.createDataFrame([(db, "sales", sales, "parquet")], "db string, tbl string, location string, format string")
    specs = life.table_specs(cols, tables)
    assert rows(life.register_external(spark, specs), "status", "action") == [("COMPLETED", "CREATE")]
    assert spark.table(f"{db}.sales").count() == 10
    spark.createDataFrame([(99, "z", 1.0, 2026, "01")], "order_id int, customer string, amount double, year int, month string").write.mode(
        "append").partitionBy("year", "month").parquet(sales)
    assert rows(life.register_external(spark, specs), "action") == [("REPAIR",)]
    assert spark.table(f"{db}.sales").count() == 11
    moved = specs.withColumn("location", F.lit(str(tmp_path / "other")))
    assert rows(life.register_external(spark, moved), "status", "action") == [("FAILED", "REFUSE")]
    assert rows(life.register_external(spark, specs, recreate=True), "action") == [("RECREATE",)]
    assert rows(catalog.tables(spark, db), "tbl", "table_type") == [("sales", "EXTERNAL")]
    assert rows(catalog.details(spark, db, ["sales"]), "format") == [("PARQUET",)]
    assert catalog.partitions(spark, db, "sales").count() == 6
    place = catalog.partition_locations(spark, db, "sales", ["year=2023/month=01"]).first()["location"]
    assert place.endswith("year=2023/month=01")
    assert db in [r["db"] for r in catalog.databases(spark).collect()]
    assert catalog.tables(spark, "no_such_db").count() == 0


def test_schema_is_inferred_without_columns(spark, db, sales):
    specs = spark.createDataFrame([(db, "s2", sales + "/year=2023", "parquet", None, [("month", "string")])],
                                  "db string, tbl string, location string, format string, columns array<struct<name:string,type:string>>, "
                                  "partition_columns array<struct<name:string,type:string>>")
    assert rows(life.register_external(spark, specs), "action", "error") == [("CREATE", None)]
    assert spark.table(f"{db}.s2").count() == 5 and spark.table(f"{db}.s2").schema["month"].dataType.simpleString() == "string"


def test_add_partitions(spark, db, sales):
    spark.sql(life.external_ddl(db, "p", [("order_id", "int")], [("year", "int"), ("month", "string")], sales))
    assert life.add_partitions(spark, f"{db}.p", sales, ["year=2023/month=12", "year=1900/month=01"]) == 2
    assert rows(catalog.partitions(spark, db, "p"), "spec") == [("year=1900/month=01",), ("year=2023/month=12",)]
    shutil.rmtree(f"{sales}/year=1900")
    life.sync_partitions(spark, f"{db}.p")
    assert "year=1900/month=01" not in [r["spec"] for r in catalog.partitions(spark, db, "p").collect()]


def test_text_table(spark, db, tmp_path):
    path = str(tmp_path / "t")
    os.makedirs(path)
    with open(f"{path}/a.txt", "w") as out:
        out.write("1\u0001x\n2\u0001\\N\n")
    spark.sql(life.external_ddl(db, "txt", [("id", "int"), ("name", "string")], [], path, "TEXTFILE"))
    assert rows(spark.table(f"{db}.txt")) == [(1, "x"), (2, None)]


def test_convert_in_place(spark, db, tmp_path):
    path = str(tmp_path / "src")
    spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "", "y")], "id int, s string, p string").write.orc(path)
    spark.sql(f"CREATE TABLE {db}.t USING orc LOCATION '{path}'")
    row = life.convert_in_place(spark, db, "t", "parquet", ["p"]).first()
    assert (row["status"], row["source_rows"], row["dest_rows"]) == ("COMPLETED", 3, 3)
    assert rows(spark.table(f"{db}.t"), "id", "s", "p") == [(1, "a", "x"), (2, None, "y"), (3, "", "y")]
    assert is_parquet(spark)(f"{db}.t") and spark.table(f"{db}.t_backup_").count() == 3
    assert life.repair_swap(spark, db, "t", path, is_parquet(spark)) == "ALREADY_MIGRATED"


def test_repair_swap(spark, db, tmp_path):
    path = str(tmp_path / "src")
    spark.range(3).write.orc(path)
    make = "CREATE TABLE {}.{} USING orc LOCATION '" + path + "'"
    done = is_parquet(spark)
    assert life.repair_swap(spark, db, "t", path, done) == "UNRECOVERABLE"
    spark.sql(make.format(db, "t"))
    assert life.repair_swap(spark, db, "t", path, done) == "READY"
    spark.sql(make.format(db, "t" + life.STAGING_ENDING))
    assert life.repair_swap(spark, db, "t", path, done) == "STAGING_CLEARED"
    spark.sql(make.format(db, "t" + life.BACKUP_ENDING))
    assert life.repair_swap(spark, db, "t", path, done) == "BACKUP_CONFLICT"
    spark.sql(f"DROP TABLE {db}.t")
    assert life.repair_swap(spark, db, "t", "/elsewhere", done) == "ROLLBACK_BLOCKED"
    spark.sql(make.format(db, "t" + life.STAGING_ENDING))
    assert life.repair_swap(spark, db, "t", path, done) == "ROLLED_BACK"
    assert sorted(t.name for t in spark.catalog.listTables(db)) == ["t"]


def test_convert_verified_finds_bad_copies(spark, tmp_path):
    data = spark.createDataFrame([(1, {"a": 1}, [(1, "x")]), (2, None, None)], "id int, m map<string,int>, s array<struct<x:int,y:string>>")
    good = life.convert_verified(spark, data, str(tmp_path / "good")).first()
    assert good["same_content"] and good["schema_match"] and good["source_rows"] == 2
    other = spark.createDataFrame([(1, {"a": 1}, [(1, "x")]), (2, {}, None)], data.schema)
    assert not life.compare_contents(data.withColumn("k", F.lit(1)), other.withColumn("k", F.lit(1)), ["k"]).first()["same_content"]


def test_decisions(spark):
    frame = spark.createDataFrame([
        (False, False, None, None, "s3://b/t"), (True, False, "PARQUET", "s3a://b/t", "s3://b/t/"), (True, False, "PARQUET", "s3a://b/u", "s3://b/t"),
        (True, True, "PARQUET", "s3a://b/u", "s3://b/t"), (True, True, "ICEBERG", "s3a://b/t", "s3://b/t")],
        "e boolean, r boolean, f string, l string, c string")
    assert [r[0] for r in frame.select(life.creation_decision("e", "r", "f", "l", "c")["decision"]).collect()] == [
        "CREATE", "REPAIR", "REFUSE", "RECREATE", "REFUSE"]
    cases = [("ICEBERG", "EXTERNAL", True, "READY"), ("VIEW", "VIEW", False, "READY"), ("TEXT", "MANAGED", True, "READY"), ("TEXT", "EXTERNAL", True, "BACKUP_CONFLICT"),
             ("TEXT", "EXTERNAL", True, "UNRECOVERABLE"), ("TEXT", "EXTERNAL", True, "ALREADY_MIGRATED"), ("TEXT", "EXTERNAL", True, "READY"), ("UNKNOWN", "x", True, "READY"),
             ("PARQUET", "x", True, "READY"), ("TEXT", "MANAGED", False, "READY")]
    table = spark.createDataFrame(cases, "f string, t string, i boolean, s string")
    got = [tuple(r) for r in table.select(life.conversion_decision("f", "t", "i", "s").alias("d")).select("d.*").collect()]
    assert got == [("NONE", "ALREADY_ICEBERG", "SKIPPED"), ("NONE", "SOURCE_IS_VIEW", "SKIPPED"), ("NONE", "MANAGED_TEXT_INPLACE_UNSUPPORTED", "SKIPPED"),
                   ("NONE", "INPLACE_CTAS_BACKUP_CONFLICT", "SKIPPED"), ("NONE", "INPLACE_CTAS_SWAP_INCOMPLETE", "FAILED"), ("DONE", None, "COMPLETED"),
                   ("IN_PLACE_COPY", None, None), ("NONE", "FORMAT_UNDETECTED_INPLACE", "SKIPPED"), ("IN_PLACE_COPY", None, None), ("COPY", None, None)]


def test_cleanup(spark, db, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(path)
    os.makedirs(f"{path}/metadata")
    spark.sql(f"CREATE TABLE {db}.t USING parquet LOCATION '{path}'")
    spark.sql(f"CREATE TABLE {db}.o (id INT) USING orc LOCATION '{tmp_path}/o'")
    names = [f"{db}.t", f"{db}.o", f"{db}.none"]
    want = ["DRY_RUN", "SKIPPED_NOT_ICEBERG", "SKIPPED_NOT_FOUND"]
    assert [r["status"] for r in life.cleanup_tables(spark, names, is_parquet(spark)).collect()] == want
    assert spark.catalog.tableExists(f"{db}.t")
    assert [r["status"] for r in life.cleanup_tables(spark, names, is_parquet(spark), dry_run=False).collect()] == ["CLEANED", *want[1:]]
    assert not spark.catalog.tableExists(f"{db}.t") and not os.path.exists(f"{path}/metadata") and spark.read.parquet(path).count() == 2


def test_copy_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "dst")
    data = spark.createDataFrame([(i, f"{i % 3:02d}") for i in range(9)], "id int, m string")
    life.write_partitioned(data.withColumn("id", F.lit(-1)), path, ["m"])
    chosen = spark.createDataFrame([("m=01",), ("m=99",)], "spec string")
    assert rows(life.copy_partitions(data, chosen, path, ["m"])) == [("m=01", True), ("m=99", False)]
    got = spark.read.parquet(path).groupBy("m").agg(F.max("id").alias("x"))
    assert {r["m"]: r["x"] for r in got.collect()} == {0: -1, 1: 7, 2: -1}


def test_convert_in_place_with_partitions_in_another_order(spark, db, tmp_path):
    path = str(tmp_path / "src")
    spark.createDataFrame([(i, 2020 + i % 3, i % 2) for i in range(10)], "id int, year int, month int").write.orc(path)
    spark.sql(f"CREATE TABLE {db}.t USING orc LOCATION '{path}'")
    before = rows(spark.table(f"{db}.t"), "id", "year", "month")
    row = life.convert_in_place(spark, db, "t", "parquet", ["month", "year"]).first()
    assert (row["status"], row["source_rows"], row["dest_rows"]) == ("COMPLETED", 10, 10)
    assert rows(spark.table(f"{db}.t"), "id", "year", "month") == before
    assert [r["spec"] for r in catalog.partitions(spark, db, "t").collect()][0].startswith("month=")


def test_convert_in_place_keeps_the_original_when_the_table_differs(spark, db, tmp_path, monkeypatch):
    path = str(tmp_path / "src")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string").write.orc(path)
    spark.sql(f"CREATE TABLE {db}.t USING orc LOCATION '{path}'")
    ddl = life.external_ddl
    monkeypatch.setattr(life, "external_ddl", lambda *a, **k: ddl(*a[:4], str(tmp_path / "elsewhere"), *a[5:], **k))
    row = life.convert_in_place(spark, db, "t", "parquet").first()
    assert (row["status"], row["dest_rows"], row["same_content"]) == ("FAILED", 0, False)
    assert spark.table(f"{db}.t").count() == 2 and [t.name for t in spark.catalog.listTables(db)] == ["t"]


def test_checksum_tells_where_a_null_stands(spark):
    def frame(*data):
        return spark.createDataFrame(list(data), "a string, b string, s struct<x:int,y:int>, k int")

    one = frame(("x", None, (1, None), 1))
    assert life.compare_contents(one, one, ["k"]).first()["same_content"]
    assert not life.compare_contents(one, frame((None, "x", (1, None), 1)), ["k"]).first()["same_content"]
    assert not life.compare_contents(one, frame(("x", None, (None, 1), 1)), ["k"]).first()["same_content"]


def test_null_partition_is_copied_and_verified(spark, tmp_path):
    data = spark.createDataFrame([(1, "a"), (2, None)], "id int, p string")
    chosen = data.select(parts.make_spec("p").alias("spec"))
    path = str(tmp_path / "dst")
    assert rows(life.copy_partitions(data, chosen, path, ["p"])) == [("p=__HIVE_DEFAULT_PARTITION__", True), ("p=a", True)]
    assert rows(spark.read.parquet(path), "id", "p") == [(1, "a"), (2, None)]
    done = life.convert_verified(spark, data, str(tmp_path / "conv"), partition_by=["p"])
    assert rows(done, "p", "source_rows", "dest_rows", "same_content") == [("a", 1, 1, True), (None, 1, 1, True)]


def test_specs_are_named_as_spark_names_directories(spark, db, tmp_path):
    odd = ["2024-01-01 10:00:00", "a/b", "50%", "x=y", "q?#*", "[z]^{", "plain é", "back\\slash", "quote\"'", "", None]
    data = spark.createDataFrame([(i, v) for i, v in enumerate(odd)], "id int, p string")
    path = str(tmp_path / "t")
    data.write.partitionBy("p").parquet(path)
    made = {r["spec"] for r in data.select(parts.make_spec("p").alias("spec")).collect()}
    assert made == {d for d in os.listdir(path) if d.startswith("p=")}
    spark.sql(life.external_ddl(db, "t", [("id", "int")], [("p", "string")], path))
    spark.sql(f"ALTER TABLE {db}.t RECOVER PARTITIONS")
    assert made == {r["spec"] for r in catalog.partitions(spark, db, "t").collect()}
    back = parts.restrict(data, data.select(parts.make_spec("p").alias("spec")), ["p"])
    assert back.count() == len(odd) - 1  # an empty text is written as a missing value
