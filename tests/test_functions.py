import json

import pytest
from pyspark.sql import functions as F

from helpers import rows, values
from tablekit.functions import errors, keys, metrics, paths, text, types


@pytest.mark.parametrize("given, expected", [
    ("s3n://b/x", "s3a://b/x"), ("s3://b", "s3a://b"), ("s3a://b", "s3a://b"), ("b/x", "s3a://b/x"), ("", ""), (None, None),
    ("S3://b", "s3a://S3://b"),
])
def test_object_store_uri(spark, given, expected):
    assert values(spark, [given], paths.object_store_uri("c")) == [expected]


def test_plain_path(spark):
    given = ["hdfs://nn:8020/data//x/", "maprfs:///data/x", "/", "", None, " /a/ ", "file:/a", "relative/x", "hdfs://nn"]
    assert values(spark, given, paths.plain_path("c")) == [
        "/data/x", "/data/x", "", "", "", "/a", "/a", "/relative/x", ""]


@pytest.mark.parametrize("path, root, inside", [
    ("s3a://b/t/p=1", "s3a://b/t", True), ("s3a://b/t", "s3a://b/t/", True), ("s3a://b/tt", "s3a://b/t", False),
    ("/t/x", "s3a://b/t", True), ("hdfs://n/t/x", "s3a://b/t", False), ("s3a://c/t/x", "s3a://b/t", False),
    ("", "/t", False), ("/t", "", False), ("S3A://b//t//x", "s3a://b/t", True), ("/x", "/", True),
])
def test_is_inside(spark, path, root, inside):
    frame = spark.createDataFrame([(path, root)], "p string, r string")
    assert frame.select(paths.is_inside("p", "r")).first()[0] is inside


def test_destination_rebase_sibling(spark):
    frame = spark.createDataFrame([("s3a://old/x/t",), ("hdfs://n/t",)], "c string")
    got = frame.select(
        paths.destination_path("c", F.lit("db"), F.lit("t"), F.lit("s3a://b/"), F.lit("s3a://old"), F.lit("s3a://new/")),
        paths.rebase("c", F.lit("s3a://old/"), F.lit("s3a://new/")), paths.sibling_target("c")).collect()
    assert tuple(got[0]) == ("s3a://new/x/t", "s3a://new/x/t", "s3a://old/x/t_iceberg")
    assert tuple(got[1]) == ("s3a://b/db/t", None, None)
    assert values(spark, ["S3://b/x/"], paths.sibling_target("c")) == ["s3a://b/x_iceberg"]


def test_folder_target(spark):
    frame = spark.createDataFrame([("/data/in/", "s3: bkt//a/", None), ("/data/in", "bkt/in", "in"), ("/d", "s3n://b", "/x//y/")],
                                  "p string, b string, f string")
    out = frame.select(paths.folder_target("p", "b", "f").alias("t")).select("t.*").collect()
    assert [tuple(r) for r in out] == [("s3a://bkt/a", "in"), ("s3a://bkt", "in"), ("s3a://b", "x/y")]


def test_ancestors(spark):
    assert values(spark, ["s3a://b/x/y", "/a/b", "x"], paths.ancestors("c")) == [["s3a://b", "s3a://b/x"], ["/a"], []]
    assert values(spark, ["/a/b"], paths.ancestors("c", include_self=True)) == [["/a", "/a/b"]]


def test_types(spark):
    given = ["struct<a:int,b:array<struct<c:decimal(18,4)>>>", "decimal(18,4)"]
    assert values(spark, given, types.hive_type_to_ddl("c")) == ["struct<a int,b:array<struct<c decimal(18,4)>>>".replace("b:array", "b array"), "decimal(18,4)"]
    given = ["VARCHAR(10)", "struct<varchar:int,x:char( 3 ),y:tinyint>", "tinyint_col", "map<smallint,varchar(2)>", "varchar"]
    assert values(spark, given, types.comparable_type("c")) == [
        "string", "struct<varchar:int,x:string,y:int>", "tinyint_col", "map<int,string>", "string"]
    got = values(spark, ["bucket[16]", "identity"], types.partition_transform("c"))
    assert [tuple(g) for g in got] == [("bucket", 16), ("identity", None)]


@pytest.mark.parametrize("given, expected", [
    ("long", "BIGINT"), ("timestamptz", "TIMESTAMP"), ("decimal(9,2)", "DECIMAL(9,2)"), ("fixed[16]", "BINARY"), ("odd", "STRING"),
    (json.dumps({"type": "struct", "fields": [{"name": "a", "type": "int"}, {"name": "b", "type": {"type": "map", "key": "string", "value": {"type": "list", "element": "uuid"}}}]}),
     "STRUCT<a:INT,b:MAP<STRING,ARRAY<STRING>>>"),
])
def test_json_types(given, expected):
    assert types.sql_type_of(given) == expected


def test_cells(spark):
    assert values(spark, [" x ", "NaN", "none", "", None, "null "], text.blank_to_null("c")) == ["x", None, None, None, None, None]
    assert values(spark, ["Yes", "off", "", "maybe"], text.boolean_word("c", True)) == [True, False, True, None]
    assert values(spark, ["Yes", "", "maybe", None], text.bad_boolean_word("c")) == [False, False, True, False]
    assert values(spark, ["a, ,b ", "nan"], text.list_cell("c")) == [["a", "b"], []]
    assert values(spark, ["Read, WRITE", None], text.permission_list("c")) == [["read", "write"], ["read"]]


@pytest.mark.parametrize("database, table, column, expected", [
    ("*", "t", "c", "iceberg"), ("d", "*", "*", "iceberg.d"), ("d", "t", "*", "iceberg.d.t"), ("d", "t", "c", "iceberg.d.t.c"),
    ("d", "*", "c", "iceberg.d.*.c"),
])
def test_policy_name(spark, database, table, column, expected):
    frame = spark.createDataFrame([(database, table, column)], "d string, t string, c string")
    assert frame.select(text.policy_name(F.lit("iceberg"), "d", "t", "c")).first()[0] == expected


def test_reasons_and_ids(spark):
    assert values(spark, ["a  b\n c"], text.reason(F.lit("CODE_1"), "c")) == ["[CODE_1] a b c"]
    assert values(spark, ["[CODE_1] a", "plain", None], text.reason_code("c")) == ["CODE_1", "", ""]
    assert values(spark, ["[CODE_1] a b", "plain"], text.reason_detail("c")) == ["a b", "plain"]
    log = "x application_1_2 y application_1_1 application_1_2\nKEY= v \r\nKEY=w"
    assert values(spark, [log], text.application_ids("c")) == [["application_1_2", "application_1_1"]]
    assert values(spark, [log], text.log_value("c", "KEY")) == ["v"]
    assert values(spark, ["r->x y (user)"], text.mapping_principal("c")) == ["x y"]
    assert values(spark, ["r->x->z (group)"], text.mapping_role("c")) == ["r"]


def test_error_codes(spark):
    given = ["Cannot read: org.X Non-V1 table", "NoSuchDatabaseException: d", "Table or view not found: t", "x AccessDenied",
             "java.io.FileNotFoundException", "Table t already exists", "LazySimpleSerDe", "could not read footer",
             "cannot be cast", "java heap space", "Cannot commit: x", "java.util.concurrent.ExecutionException", None]
    assert values(spark, given, errors.migration_code("c")) == [
        "SOURCE_NOT_V1_TABLE", "DATABASE_NOT_FOUND", "TABLE_NOT_FOUND", "PERMISSION_DENIED", "DATA_PATH_MISSING",
        "DESTINATION_EXISTS", "UNSUPPORTED_SOURCE_FORMAT", "SOURCE_DATA_UNREADABLE", "UNSUPPORTED_DATA_TYPE", "RESOURCE_ERROR",
        "CONCURRENT_COMMIT_CONFLICT", "MIGRATION_ERROR", "MIGRATION_ERROR"]
    assert values(spark, ["Database 'X' not found", "odd"], errors.metadata_code("c", F.lit("x"))) == [
        "DATABASE_NOT_FOUND", "METADATA_READ_ERROR"]
    assert values(spark, ["Not a Parquet file", "timeout"], errors.is_permanent("c")) == [True, False]
    frame = spark.createDataFrame([("gone", False), ("gone", None), ("Permission denied", False), ("gone", True),
                                   ("could not read schema from the hive metastore because it is corrupted", None)], "c string, e boolean")
    assert [r[0] for r in frame.select(errors.discovery_status("c", "e")).collect()] == [
        "SOURCE_PATH_NOT_FOUND", "FAILED", "FAILED", "FAILED", "TABLE_CORRUPTED"]


def test_sizes_and_costs(spark):
    frame = spark.createDataFrame([(1000, 1010), (1000, 1011), (10, 11), (10, 12), (0, 1)], "a long, b long")
    assert [r[0] for r in frame.select(metrics.size_matches("a", "b")).collect()] == [True, False, True, False, True]
    effective = spark.createDataFrame([(True, 2, 10), (True, None, 10), (False, 2, 10), (None, 2, None)], "f boolean, x long, t long")
    assert [r[0] for r in effective.select(metrics.effective("f", "x", "t")).collect()] == [2, 10, 10, 0]
    mib = 1024 * 1024
    tables = spark.createDataFrame(
        [(150 * mib, 10, 3, 2, True, False), (150 * mib, 10, 3, 2, False, False), (5, 1, 0, 0, True, False), (0, 0, 4, 0, True, False),
         (0, 0, 4, 0, False, False), (5, 1, 1, 1, True, True)], "s long, n long, p long, j long, a boolean, e boolean")
    cost = [r[0] for r in tables.select(metrics.copy_seconds("s", "n", "p", "j", "a", "e")).collect()]
    assert cost == pytest.approx([30 + 1 + 90 + 72 + 0.02, 30 + 1 + 45 + 24 + 0.02, 30, 38, 32, 0])
    caps = spark.createDataFrame([(1200.0,), (1e9,)], "t double").select(metrics.batch_cap("t", 3, 28800)).collect()
    assert [c[0] for c in caps] == pytest.approx([200, 20736])
    assert [r[0] for r in spark.createDataFrame([(0,), (1,), (100,)], "n long").select(metrics.budget_mbps("n", 50, 2)).collect()] == [2, 2, 100]


def test_keys(spark):
    import hashlib

    frame = spark.createDataFrame([("a", None, "x'y")], "a string, b string, c string")
    want = hashlib.sha256(json.dumps(["a", None, "x'y"], separators=(",", ":")).encode()).hexdigest()
    assert frame.select(keys.identity("a", "b", "c")).first()[0] == want
    assert values(spark, [None, "", "x"], keys.slice_key("c")) == ["", "", "x"]
    spans = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 00:01:30"), ("odd", "2024-01-01 00:00:00")], "a string, b string")
    assert [r[0] for r in spans.select(keys.seconds_between("a", "b")).collect()] == [90.0, None]


@pytest.mark.parametrize("long_text, limit, check", [
    ("g" * 10, 4000, lambda d: d["groups"] == "g" * 10), ("g" * 5000, 200, lambda d: d["groups"].endswith("...")),
    ("g" * 50, 45, lambda d: d["groups"] is None or d["groups"].endswith("...")), ("g", 5, lambda d: d == {"phase": "p", "groups": None}),
])
def test_bounded_json(spark, long_text, limit, check):
    frame = spark.createDataFrame([("p", long_text)], "phase string, groups string")
    out = frame.select(keys.bounded_json(F.struct("phase", "groups"), "groups", limit)).first()[0]
    assert check(json.loads(out)) and (len(out) <= limit or limit < 20)


def test_preview(spark):
    frame = spark.createDataFrame([(["a", "b", "c"], 3), (["a"], 1)], "x array<string>, n long")
    assert rows(frame.select(text.preview(F.col("x"), F.col("n"), 2))) == [("a",), ("a; b (+1 more)",)]
