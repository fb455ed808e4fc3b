import itertools

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tablekit.operators import reconcile, schemas, state

RUN = "run_20240101_000000_0123abcd"


def events(spark, data):
    full = [(RUN, "db", t, "dw", None, phase, status, attempt, cp, seq, None) for t, phase, status, attempt, cp, seq in data]
    return spark.createDataFrame(full, state.EVENT_DDL)


@pytest.mark.parametrize("history, expected", [
    ([("discovery", "DISCOVERED"), ("copy", "COPIED"), ("create", "TABLE_CREATED"), ("validate", "VALIDATED")], "VALIDATED"),
    ([("copy", "FAILED"), ("create", "TABLE_CREATED")], "FAILED"),
    ([("copy", "EMPTY_SOURCE"), ("validate", "FAILED")], "EMPTY_SOURCE"),
    ([("discovery", "SKIPPED_VIEW"), ("copy", "FAILED")], "SKIPPED_VIEW"),
    ([("create", "TABLE_CREATED"), ("validate", "VALIDATION_FAILED")], "VALIDATION_FAILED"),
])
def test_status_does_not_depend_on_event_order(spark, history, expected):
    for n, order in enumerate(itertools.islice(itertools.permutations(history), 3)):
        frame = events(spark, [("t", p, s, 1, False, i) for i, (p, s) in enumerate(order)])
        assert rows(state.overall_status(frame, list(state.SLICE)), "status") == [(expected,)]


def test_later_attempt_of_a_phase_wins(spark):
    frame = events(spark, [("t", "copy", "FAILED", 1, True, 1), ("t", "copy", "COPIED", 2, False, 2)])
    assert rows(state.overall_status(frame, list(state.SLICE)), "status") == [("COPIED",)]


def test_settle_attempts(spark):
    frame = events(spark, [("a", "copy", "COMPLETED", 1, False, 1), ("a", "copy", "RUNNING", 1, True, 2), ("b", "copy", "RUNNING", 1, True, 1),
                           ("b", "copy", "COMPLETED", 2, False, 2)])
    got = rows(state.settle_attempts(frame, ["source_table"]), "source_table", "status", "error_message")
    assert got == [("a", "FAILED", "Attempt 1 was interrupted before it ended"), ("b", "COMPLETED", None)]


def test_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    assert state.read_events(spark, path).count() == 0
    state.append_events(events(spark, [("a", "copy", "FAILED", 1, True, 1)]).drop("error_message"), path)
    state.append_events(events(spark, [("a", "copy", "COPIED", 2, True, 2), ("b", "copy", "COPIED", 1, True, 3)]), path)
    log = state.read_events(spark, path)
    assert log.count() == 3 and "error_message" in log.columns
    small = state.read_events(spark, state.compact(spark, path, list(state.SLICE)))
    assert rows(small, "source_table", "status", "attempt") == [("a", "COPIED", 2), ("b", "COPIED", 1)]


def test_runs(spark):
    start = state.open_run(spark, RUN, "2024-01-01 00:00:00")
    outcome = state.run_outcome(spark.createDataFrame([(RUN, "VALIDATED")], "run_id string, status string"), "copy", ["run_id"])
    view = state.run_view(start.unionByName(state.close_run(outcome, "2024-01-01 01:00:00")))
    assert rows(view) == [(RUN, "COMPLETED", "2024-01-01 00:00:00", "2024-01-01 01:00:00")]
    assert rows(state.run_view(start), "status") == [("RUNNING",)]
    for bad in ("", None, "run_1", RUN + "/..", "x" + RUN):
        with pytest.raises(ValueError):
            state.check_run_id(bad)


@pytest.mark.parametrize("flow, statuses, expected", [
    ("copy", [], "FAILED"), ("copy", ["VALIDATED", "SKIPPED_VIEW"], "COMPLETED"), ("copy", ["VALIDATED", "TABLE_NOT_FOUND"], "COMPLETED_WITH_MISSING"),
    ("copy", ["TABLE_NOT_FOUND", "FAILED"], "COMPLETED_WITH_FAILURES"), ("conversion", ["VALIDATION_FAILED"], "COMPLETED_WITH_FAILURES"),
    ("folder", ["SOURCE_NOT_FOUND"], "COMPLETED"), ("folder", ["VALIDATION_SKIPPED"], "COMPLETED_WITH_ERRORS"), ("catalog", ["DATA_MISSING"], "COMPLETED_WITH_MISSING"),
    ("policy", ["CREATED", "FAILED"], "PARTIAL_FAILURE"), ("registration", ["REGISTERED", "SKIPPED"], "COMPLETED"),
])
def test_run_outcome(spark, flow, statuses, expected):
    frame = spark.createDataFrame([(s,) for s in statuses], "status string")
    assert state.run_outcome(frame, flow).first()["run_status"] == expected


def test_merge_latest(spark):
    old = spark.createDataFrame([("a", "S", "keep", 1), ("b", "S", "x", 2)], "k string, status string, note string, n int")
    new = spark.createDataFrame([("a", "T", "", 3, 1), ("a", "U", "", 4, 2), ("c", "V", "y", None, 1)], "k string, status string, note string, n int, seq int")
    assert rows(state.merge_latest(old, new, ["k"], ["note"], [F.col("seq")])) == [
        ("a", "U", "keep", 4), ("b", "S", "x", 2), ("c", "V", "y", None)]


def test_attach_results(spark):
    tables = spark.createDataFrame([("t", "f1"), ("t", None), ("u", "f9"), ("v", "")], "tbl string, partition_filter string")
    results = spark.createDataFrame([("t", "f1", 1), ("t", "", 2), ("u", "f2", 3)], "tbl string, partition_filter string, n int")
    got = rows(state.attach_results(tables, results, ["tbl", "partition_filter"], ["tbl"], ["n"]), "tbl", "partition_filter", "n", "matched_by")
    assert got == [("t", "", 2, "slice"), ("t", "f1", 1, "slice"), ("u", "f9", 3, "table"), ("v", "", None, "none")]


@pytest.mark.parametrize("rows_ok, parts_ok, schema_ok, part_schema_ok, n, strict, expected", [
    (True, True, True, True, 5, True, "VALIDATED"), (True, True, True, True, 0, True, "EMPTY_SOURCE"), (False, True, True, True, 5, True, "VALIDATED_WITH_WARNINGS"),
    (True, False, True, True, 5, True, "VALIDATED_WITH_WARNINGS"), (None, True, True, True, None, True, "VALIDATED_WITH_WARNINGS"),
    (None, True, False, True, None, True, "VALIDATION_FAILED"), (True, True, False, True, 5, True, "VALIDATION_FAILED"), (True, True, True, False, 5, True, "VALIDATION_FAILED"),
    (False, True, False, True, 5, True, "VALIDATION_FAILED"), (False, True, False, True, 5, False, "VALIDATED_WITH_WARNINGS"),
])
def test_verdict(spark, rows_ok, parts_ok, schema_ok, part_schema_ok, n, strict, expected):
    frame = spark.createDataFrame([(rows_ok, parts_ok, schema_ok, part_schema_ok, n)], "r boolean, p boolean, s boolean, q boolean, n int")
    assert frame.select(reconcile.verdict("r", "p", "s", "q", "n", "n", strict)).first()[0] == expected


def test_reconcile_with_schemas(spark):
    src = spark.createDataFrame([("t", "p=1", 5), ("t", "p=2", 5), ("e", "p=1", 0)], "tbl string, spec string, row_count long")
    dst = spark.createDataFrame([("t", "p=1", 5), ("t", "p=3", 4), ("e", "p=1", 0)], "tbl string, spec string, row_count long")
    cat = "db string, tbl string, pos int, name string, type string"
    a = spark.createDataFrame([("d", "t", 0, "id", "int"), ("d", "t", 1, "name", "string"), ("d", "e", 0, "x", "int")], cat)
    b = spark.createDataFrame([("d", "t", 0, "ID", "int"), ("d", "t", 1, "extra", "int"), ("d", "e", 0, "x", "int")], cat)
    checks = schemas.compare_schemas(a, b, keys=("tbl",))
    got = {r["tbl"]: r for r in reconcile.reconcile(src, dst, ["tbl"], ["spec"], schemas=checks).collect()}
    assert got["e"]["status"] == "EMPTY_SOURCE" and got["t"]["status"] == "VALIDATION_FAILED"
    assert got["t"]["error_message"] == (
        "Row count mismatch: source=10, dest=9; Schema differences: Missing column: name; Extra column in dest: extra")


def test_partition_columns_of_an_unpartitioned_source_match(spark):
    ddl = "db string, tbl string, pos int, name string, type string, is_partition boolean"
    a = spark.createDataFrame([("d", "t", 0, "x", "int", False)], ddl)
    b = spark.createDataFrame([("d", "t", 0, "x", "int", True)], ddl)
    assert rows(schemas.compare_partition_columns(a, b), "schema_match") == [(True,)]
    c = spark.createDataFrame([("d", "t", 0, "x", "date", True)], ddl)
    assert rows(schemas.compare_partition_columns(c, b), "differences") == [("Partition type mismatch for x: date vs int",)]


def test_nested_types_compare_after_normalising(spark):
    source = spark.createDataFrame([], "id int, labels struct<name:string,code:string>, t array<struct<x:tinyint>>")
    cat_a = spark.createDataFrame([("d", "t", 0, "labels", "struct<name:varchar(255),code:char(10)>")], "db string, tbl string, pos int, name string, type string")
    cat_b = spark.createDataFrame([("d", "t", 0, "labels", "struct<name:string,code:string>")], cat_a.schema)
    assert rows(schemas.compare_schemas(cat_a, cat_b, normalise=True), "schema_match") == [(True,)]
    assert rows(schemas.compare_schemas(cat_a, cat_b), "schema_match") == [(False,)]
    assert schemas.columns_of(spark, {("d", "t"): source}).count() == 3
