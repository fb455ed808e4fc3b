import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tablekit.sources import checkpoints, datasets, files, metadata, reports, sheets

RUN = "run_20240101_000000_0123abcd"


def put(root, name, text="x"):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return path


def test_inventory_and_partitions(spark, tmp_path):
    root = str(tmp_path / "lake dir")
    for name in ("year=2023/month=01/a.bin", "year=2023/month=01/b c.bin", "year=2024/month=1/a.bin", "junk/a.bin", "year=2024/x.bin"):
        put(root, name, "12345")
    put(root, "year=2023/month=01/_SUCCESS", "")
    found = files.file_inventory(spark, root)
    assert rows(found, "rel_path", "length")[0] == ("junk/a.bin", 5) and found.count() == 5
    assert ("year=2023/month=01/b c.bin", 5) in rows(found, "rel_path", "length")
    specs = files.partition_specs(found, depth=2)
    assert rows(specs, "spec") == [("year=2023/month=01",), ("year=2024/month=1",)]
    assert files.partition_keys(specs) == ["year", "month"]
    assert rows(files.path_totals(files.partition_files(found), ["spec"])) == [
        ("", 1, 5), ("year=2023/month=01", 2, 10), ("year=2024", 1, 5), ("year=2024/month=1", 1, 5)]
    assert files.file_inventory(spark, str(tmp_path / "none")).count() == 0
    assert "content" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_sheets(spark, tmp_path):
    path = put(str(tmp_path), "s.csv", 'Database , Table,Dest Database,BUCKET,Partition Filter\nd,"a,b",,s3://x,"dt>=\'2024-01-01\'"\ne,,k,,\n')
    sheet = sheets.read_manifest(spark, path, "table_copy")
    got = [tuple(r) for r in sheet.orderBy("row_index").select("database", "table", "dest_database", "bucket", "partition_filter", "endpoint").collect()]
    assert got == [("d", "a,b", None, "s3://x", "dt>='2024-01-01'", None), ("e", None, "k", None, None, None)]
    with pytest.raises(ValueError, match="s3_location"):
        sheets.read_manifest(spark, path, "registration")
    doc = put(str(tmp_path), "s.json", json.dumps([{"Role": "r", "Database": 1}, {"Role": None}]))
    assert rows(sheets.read_manifest(spark, doc, "access_matrix", "json"), "role", "database", "url") == [("r", "1", None), (None, None, None)]
    with pytest.raises(ValueError):
        sheets.read_manifest(spark, path, "table_copy", "xlsx")


def test_checkpoints(spark, tmp_path):
    path = str(tmp_path / "cp")
    assert checkpoints.read_checkpoints(spark, path).count() == 0
    other = RUN[:-1] + "e"
    data = spark.createDataFrame([(RUN, "a", 1, "FAILED"), (RUN, "a", 2, "COMPLETED"), (other, "a", 1, "COMPLETED")],
                                 "run_id string, source_table string, attempt int, status string")
    checkpoints.write_checkpoints(data, path)
    assert checkpoints.read_checkpoints(spark, path).count() == 3
    assert rows(checkpoints.read_checkpoints(spark, path, RUN), "attempt", "status", "error") == [(1, "FAILED", None), (2, "COMPLETED", None)]
    assert checkpoints.drop_run(spark, path, RUN) and checkpoints.read_checkpoints(spark, path).count() == 1
    with pytest.raises(ValueError):
        checkpoints.drop_run(spark, path, "*")


def test_formats(spark, tmp_path):
    data = spark.createDataFrame([(1, "a|b", None), (2, "", "x\\y"), (3, "\\N", "\u0001")], "id int, s string, t string")
    for delimiter in ("|", "\u0001"):
        path = str(tmp_path / f"text{ord(delimiter)}")
        datasets.write_delimited(data, path, delimiter)
        assert rows(datasets.read_delimited(spark, path, "id int, s string, t string", delimiter)) == rows(data)
    tree = str(tmp_path / "tree")
    spark.createDataFrame([(1, "01")], "a int, m string").write.partitionBy("m").parquet(tree)
    spark.createDataFrame([(2, "x", "1")], "a int, b string, m string").write.mode("append").partitionBy("m").parquet(tree)
    before = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    assert rows(datasets.read_parquet_tree(spark, tree), "a", "b", "m") == [(1, None, "01"), (2, "x", "1")]
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == before
    spark.range(3).write.orc(str(tmp_path / "orc"))
    assert datasets.read_dataset(spark, "ORC", str(tmp_path / "orc")).count() == 3
    with pytest.raises(RuntimeError, match="spark-avro"):
        datasets.read_dataset(spark, "avro", str(tmp_path / "orc"))
    words = spark.createDataFrame([("iceberg",), ("x MapredParquetInputFormat",), ("TextInputFormat LazySimpleSerDe",), (None,), ("VIEW",)], "c string")
    assert [r[0] for r in words.select(datasets.storage_format(F.col("c"))).collect()] == ["ICEBERG", "PARQUET", "TEXT", "UNKNOWN", "VIEW"]


def document(version, current=7, prefix="s3a://old"):
    return json.dumps({
        "format-version": 2, "location": "s3a://old/t", "current-schema-id": 1, "default-spec-id": 5, "current-snapshot-id": current,
        "schemas": [{"schema-id": 0, "fields": []}, {"schema-id": 1, "fields": [
            {"id": 1, "name": "id", "type": "long"}, {"id": 2, "name": "ts", "type": "timestamptz"},
            {"id": 3, "name": "s", "type": {"type": "struct", "fields": [{"name": "a", "type": "decimal(9,2)"}]}}]}],
        "partition-specs": [{"spec-id": 0, "fields": []}, {"spec-id": 5, "fields": [
            {"name": "id_b", "source-id": 1, "transform": "bucket[16]"}, {"name": "x", "source-id": 99, "transform": "identity"}]}],
        "snapshots": [{"snapshot-id": 6, "manifest-list": f"{prefix}/m6", "summary": {"total-records": "1"}},
                      {"snapshot-id": 7, "manifest-list": "s3a://new/m7", "summary": {"total-records": str(version)}}]}, indent=1)


def test_metadata_documents(spark, tmp_path):
    root = str(tmp_path / "wh")
    for version in (1, 2, 10):
        put(root, f"t/metadata/v{version}.metadata.json", document(version))
    put(root, "t/metadata/snap-1.avro")
    for version in ("00001-aa", "00012-bb"):
        put(root, f"u/metadata/{version}.metadata.json", document(12, current=None))
    put(root, "h/metadata/v1.metadata.json", document(1))
    put(root, "h/metadata/v2.metadata.json", document(2))
    put(root, "h/metadata/version-hint.text", "1\n")
    put(root, "plain/data/x")
    found = files.file_inventory(spark, root)
    assert rows(files.tables_with_metadata(found), "tbl") == [("h",), ("t",), ("u",)]
    current = metadata.current_metadata_files(found, metadata.version_hints(spark, root))
    assert {r["tbl"]: r["path"].rsplit("/", 1)[1] for r in current.collect()} == {
        "t": "v10.metadata.json", "u": "00012-bb.metadata.json", "h": "v1.metadata.json"}
    docs = metadata.current_documents(spark, root, found, metadata.version_hints(spark, root))
    assert rows(metadata.schema_columns(docs).where("tbl = 't'"), "pos", "name", "type") == [
        (0, "id", "BIGINT"), (1, "ts", "TIMESTAMP"), (2, "s", "STRUCT<a:DECIMAL(9,2)>")]
    assert rows(metadata.partition_fields(docs).where("tbl = 't'"), "source_column", "transform", "param", "name") == [
        ("field_99", "identity", None, "x"), ("id", "bucket", 16, "id_b")]
    assert rows(metadata.snapshot_facts(docs)) == [("h", 2, 2, 1, True), ("t", 2, 2, 10, True), ("u", 2, 2, 0, True)]
    expected = spark.createDataFrame([("t", "s3a://old/", "s3a://new", 2), ("u", "", "", 0), ("h", "s3a://x", "s3a://y", 3)],
                                     "tbl string, source_prefix string, dest_prefix string, source_snapshots int")
    assert rows(metadata.check_rewrite(metadata.snapshots(docs), expected), "tbl", "stale_snapshots", "rewrite_ok", "snapshot_count_match") == [
        ("h", 0, True, False), ("t", 1, False, True), ("u", 0, True, True)]


def test_reports_and_sources(spark, tmp_path):
    out = spark.createDataFrame([("d", "t", "p=1", "/x,y", True, 2, 10, None)],
                                "database string, table string, partition string, location string, exists boolean, file_count long, size_bytes long, row_count long")
    reports.write_outside_report(out, str(tmp_path / "csv"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "csv")), "location", "row_count") == [("/x,y", None)]
    issues = spark.createDataFrame([("a.py", "R", "high")], "path string, rule_id string, severity string")
    reports.write_issue_report(issues, issues.groupBy("rule_id").count(), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json" / "issues")).count() == 1
    root = str(tmp_path / "src")
    put(root, "a/x.py", "one\ntwo\n")
    put(root, "y.sql", "select 1")
    got = files.read_sources(spark, root).collect()
    assert sorted((r["path"].rsplit("/", 1)[1], r["text"]) for r in got) == [("x.py", "one\ntwo\n"), ("y.sql", "select 1")]
