import pytest
from pyspark.sql import functions as F

from helpers import rows
from tablekit.operators import policy

COLUMNS = ("role", "database", "tables", "columns", "url", "permissions", "groups", "users", "rowfilter", "item_type", "policy_label")
DDL = "sheet string, row_index long, " + ", ".join(f"{c} string" for c in COLUMNS)


def matrix(spark, *cells):
    return spark.createDataFrame([("s", i, *[row.get(c) for c in COLUMNS]) for i, row in enumerate(cells)], DDL)


def facts(spark, *cells):
    valid, _ = policy.parse_matrix(matrix(spark, *cells))
    return policy.grant_facts(policy.expand_policies(policy.bind_roles(valid)))


@pytest.mark.parametrize("chunk", [1, 2, 65_536])
def test_fill_down(spark, chunk):
    sheet = matrix(
        spark,
        {"role": "r"},
        {"database": "d1", "tables": "t1", "policy_label": "l1"},
        {"columns": "c1"},
        {"tables": "t2"},
        {"database": "d2"},
        {"url": "s3a://u", "policy_label": "l2"},
        {"url": "-"},
        {"url": "s3a://v"},
        {"database": "d3", "url": "s3a://w"},
        {},
        {"url": "s3a://x"},
        {"database": "nan", "tables": "t9"},
    )
    got = policy.fill_down(sheet, chunk_rows=chunk).orderBy("row_index").select("database", "url", "tables", "columns", "policy_label").collect()
    assert [tuple(r) for r in got] == [
        (None, None, "*", "*", None), ("d1", None, "t1", "*", "l1"), ("d1", None, "t1", "c1", "l1"), ("d1", None, "t2", "c1", "l1"),
        ("d2", None, "*", "*", "l1"), (None, "s3a://u", "*", "*", "l2"), (None, "s3a://u", "*", "*", "l2"), (None, "s3a://v", "*", "*", "l2"),
        ("d3", "s3a://w", "*", "*", "l2"), ("d3", "s3a://w", "*", "*", "l2"), (None, "s3a://x", "*", "*", "l2"), (None, "s3a://x", "t9", "*", "l2")]


def test_parse_matrix_rejects(spark):
    valid, rejected = policy.parse_matrix(matrix(
        spark,
        {"role": "r"},
        {"role": "r", "database": "d", "url": "s3a://u"},
        {"role": "r", "url": "s3a://u", "rowfilter": "x=1"},
        {"database": "d", "groups": "g"},
        {"database": "d"},
        {"role": "r", "database": "d", "rowfilter": "x=1; drop"},
        {"role": "r", "database": "d", "rowfilter": "x=1", "item_type": "Deny"},
        {"role": "r", "database": "d", "rowfilter": "x=1", "item_type": "whatever"},
        {"database": "d", "users": "a, b"},
    ))
    assert [(r["row_index"], r["reason"][:18]) for r in rejected.orderBy("row_index").collect()] == [
        (0, "needs a database o"), (1, "needs a database o"), (2, "row filter on a ur"), (3, "groups without a r"), (4, "no role, group or "),
        (5, "unsafe row filter"), (6, "row filter ignored")]
    assert rows(valid, "row_index", "item_type", "rowfilter") == [(6, "deny", None), (7, "allow", "x=1"), (8, "allow", None)]
    bound = policy.bind_roles(valid)
    assert rows(bound.where("row_index = 8"), "role", "user_list") == [("role_a", ["a"]), ("role_b", ["b"])]


def test_grants(spark):
    found = facts(
        spark,
        {"role": "r", "database": "d, *", "tables": "t1,t2", "groups": "g", "permissions": "Read"},
        {"role": "r", "database": "d", "tables": "t1", "users": "u", "permissions": "write,read", "rowfilter": "a=1"},
        {"role": "r", "database": "d", "tables": "t1", "rowfilter": "a=2"},
        {"role": "q", "url": "s3a://x"},
    )
    assert rows(found.where("policy = 'iceberg.d.t1'"), "kind", "value") == [
        ("group", "g"), ("permission", "read"), ("permission", "write"), ("rowfilter", "a=1"), ("rowfilter", "a=2"), ("user", "u")]
    assert rows(found.select("policy").distinct()) == [("iceberg",), ("iceberg.d.t1",), ("iceberg.d.t2",), ("s3a://x",)]
    assert rows(policy.rowfilter_conflicts(found)) == [("iceberg.d.t1", "r", "allow", 2, "a=1", "a=2")]
    assert ("s3a://x", "q", "allow", 1, 0, 0, None) in rows(policy.grant_summary(found))


@pytest.mark.parametrize("kind, word, expected", [
    ("table", "read", sorted(policy.READ)), ("table", "ALL", sorted(policy.ALL)), ("table", "select", ["select"]), ("table", "odd", ["odd"]),
    ("url", "all", ["read", "write"]), ("url", "select", ["read"]), ("url", "list", ["list"]),
])
def test_access_types(spark, kind, word, expected):
    frame = spark.createDataFrame([("p", kind, word)], "policy string, policy_type string, permission string")
    assert sorted(r["access"] for r in policy.access_types(frame).collect()) == expected
    lookup = policy.permission_map(spark)
    assert lookup.where((F.col("policy_type") == kind) & (F.col("permission") == word.lower())).count() in (0, len(expected))


def test_supported_access_and_failing_policies(spark):
    frame = spark.createDataFrame([("p", "r", "allow", "odd"), ("q", "r", "allow", "select"), ("q", "r", "allow", "odd"), ("s", "r", "allow_exception", "select")],
                                  "policy string, role string, item_type string, access string")
    kept, dropped, empty = policy.supported_access(frame, ["select"], list(policy.GRANT))
    assert dropped.count() == 2 and rows(empty) == [("p", "r", "allow")]
    assert rows(policy.failing_policies(policy.policy_items(kept), frame)) == [("p",), ("s",)]
    assert policy.supported_access(frame, None, list(policy.GRANT))[0].count() == 4


def test_merges(spark):
    ddl = "policy string, grp string, rowfilter string"
    old = spark.createDataFrame([("p", "a", "x=1"), ("p", "b", "x=2")], ddl)
    new = spark.createDataFrame([("p", "b", "x=3"), ("p", "c", "x=4")], ddl)
    assert rows(policy.merge_rowfilters(old, new)) == [("p", "a", "x=1"), ("p", "b", "x=3"), ("p", "c", "x=4")]
    labels = spark.createDataFrame([("p", "l")], "policy string, label string")
    assert policy.merge_labels(labels, labels).count() == 1


def test_keep_mapped(spark):
    found = facts(spark, {"role": "r", "database": "d", "groups": "g1,g2"}, {"role": "q", "database": "d", "users": "u"}, {"role": "z", "url": "s3a://x", "users": "u"})
    mapped = spark.createDataFrame([("r", "group", "g1")], "role string, type string, principal string")
    kept, grants, failed = policy.keep_mapped(found, mapped)
    assert rows(kept, "role", "kind", "value") == [("r", "group", "g1"), ("r", "permission", "read")]
    assert rows(grants, "role", "state") == [("q", "excluded"), ("r", "applied"), ("z", "excluded")]
    assert rows(failed, "policy") == [("s3a://x",)]
    results = spark.createDataFrame([("iceberg.d", "7", "CREATED", ""), ("iceberg.d__rowfilter", "8", "FAILED", "x"), ("s3a://x", None, "FAILED", "bad")],
                                    "policy string, policy_id string, status string, error_message string")
    assert rows(policy.final_statuses(grants, results), "policy", "policy_id", "status", "applied_roles", "error_message") == [
        ("iceberg.d", "7", "CREATED", "r", "excluded role(s) without a mapped principal: q"), ("s3a://x", "s3a://x", "FAILED", None, "bad")]


def test_spread_ids_only_fills_blanks(spark):
    ddl = "object_type string, object_name string, policy_name string, policy_id string"
    objects = spark.createDataFrame([
        ("policy", "p1", None, None), ("policy", "p1__rowfilter", "", ""), ("mapping", "r1->u (user)", None, None), ("mapping", "r2->g (group)", None, None),
        ("role", "r1", None, None), ("role", "r2", "kept", "9"), ("ranger_group", "r1", None, None), ("keycloak_group", "g", None, None), ("other", "x", None, None)], ddl)
    applied = spark.createDataFrame([("p1", "1", "u"), ("p2", "2", "u"), ("p2", "2", "g"), ("", "3", "u")], "policy_name string, policy_id string, principal string")
    texts = policy.id_texts(policy.spread_ids(objects, applied))
    assert rows(texts, "object_type", "object_name", "policy_name", "policy_id") == [
        ("keycloak_group", "g", "p2", "2"), ("mapping", "r1->u (user)", "p1, p2", "1, 2"), ("mapping", "r2->g (group)", "p2", "2"), ("other", "x", "", ""),
        ("policy", "p1", "p1", "1"), ("policy", "p1__rowfilter", "p1", "1"), ("ranger_group", "r1", "p1, p2", "1, 2"), ("role", "r1", "p1, p2", "1, 2"), ("role", "r2", "kept", "9")]


def test_statuses(spark):
    people = spark.createDataFrame([("r", "group", "g"), ("r", "user", "u"), ("q", "group", "gone")], "role string, type string, principal string")
    current = spark.createDataFrame([("r", "group", "g")], "role string, type string, principal string")
    directory = spark.createDataFrame([("g",)], "grp string")
    out = policy.mapping_statuses(people, current, directory)
    assert rows(out) == [("keycloak_group", "g", "ALREADY_EXISTS"), ("keycloak_group", "gone", "FAILED"), ("mapping", "r->g (group)", "ALREADY_EXISTS"),
                         ("mapping", "r->u (user)", "CREATED"), ("role", "q", "CREATED"), ("role", "r", "ALREADY_EXISTS")]
    metrics = policy.run_metrics(out.unionByName(spark.createDataFrame([("policy", "p", "RUNNING")], out.schema))).first()
    assert (metrics["failed_objects"], metrics["policies_failed"], metrics["overall_status"]) == (2, 1, "PARTIAL_FAILURE")
    assert policy.outage_statuses(people, "down").count() == 2 + 2 + 3
