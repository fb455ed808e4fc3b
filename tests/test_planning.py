import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from tablekit.operators import copyplan, locations, tokens


def brute_first_fit(costs, cap, most):
    bins, out = [], []
    for c in costs:
        for i, (used, n) in enumerate(bins):
            if n < most and used + c <= cap:
                bins[i] = (used + c, n + 1)
                out.append(i)
                break
        else:
            bins.append((c, 1))
            out.append(len(bins) - 1)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_first_fit_matches_brute_force(seed):
    rng = random.Random(seed)
    costs = sorted((rng.randint(0, 40) for _ in range(200)), reverse=True)
    assert list(copyplan.first_fit(np.array(costs, float), 30, 7)) == brute_first_fit(costs, 30, 7)


@pytest.mark.parametrize("shards", [1, 4])
def test_packing_keeps_every_table(spark, shards):
    rng = random.Random(3)
    data = [(f"db{i % 3}" if i % 4 else "hot", f"t{i}", float(rng.choice([0, 10, 50, 99, 400]))) for i in range(300)]
    tables = spark.createDataFrame(data, "db string, tbl string, cost double")
    got = copyplan.pack_batches(tables, cap=120, max_tables=5, shards=shards).collect()
    assert sorted((r["db"], r["tbl"]) for r in got) == sorted((d, t) for d, t, _ in data)
    batches = {}
    for r in got:
        batches.setdefault(r["batch"], []).append(r)
    for members in batches.values():
        total = sum(m["cost"] for m in members)
        assert len({m["db"] for m in members}) == 1 and len(members) <= 5
        assert total <= 120 or len([m for m in members if m["cost"]]) == 1 and total == 400
        assert {(m["batch_cost"], m["batch_tables"]) for m in members} == {(total, len(members))}
    ranks = sorted({(r["batch_rank"], r["batch_cost"]) for r in got})
    assert [r for r, _ in ranks] == list(range(len(batches)))
    assert [c for _, c in ranks] == sorted((c for _, c in ranks), reverse=True)


def test_sync_plan(spark):
    ddl = "rel_path string, length long"
    src = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], ddl)
    dst = spark.createDataFrame([("b", 2), ("c", 4), ("d", 5)], ddl)
    assert rows(copyplan.sync_plan(src, dst), "rel_path", "action", "bytes") == [
        ("a", "COPY", 1), ("b", "SKIP", 0), ("c", "COPY", 3), ("d", "KEEP", 0)]
    assert ("d", "DELETE", 5) in rows(copyplan.sync_plan(src, dst, delete=True), "rel_path", "action", "bytes")


def test_split_folders(spark):
    files = spark.createDataFrame(
        [("r1", p, 1) for p in ("a/x", "a/y/z", "b/x", "top")] + [("r2", "only", 1)] + [("r3", f"f{i}", 1) for i in range(3)]
        + [("r3", "d/x", 1)], "root string, rel_path string, length long")
    got = rows(copyplan.split_folders(files, depth=1, max_loose=2))
    assert got == [("r1", "", "loose_files", 1, 1, False), ("r1", "a", "subfolder", 2, 2, False), ("r1", "b", "subfolder", 1, 1, False),
                   ("r2", "", "whole", 1, 1, False), ("r3", "", "loose_files", 3, 3, True), ("r3", "d", "subfolder", 1, 1, True)]
    deep = rows(copyplan.split_folders(files.where("root = 'r1'"), depth=2).drop("over_limit"))
    assert deep == [("r1", "", "loose_files", 1, 1), ("r1", "a", "loose_files", 1, 1), ("r1", "a/y", "subfolder", 1, 1),
                    ("r1", "b", "subfolder", 1, 1)]
    over = copyplan.split_folders(files.where("root = 'r1'"), max_units=2)
    assert over.count() == 3 and over.where("over_limit").count() == 3


def test_resume(spark):
    units = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "checkpoint_key string")
    seen = spark.createDataFrame(
        [("a", 1, "FAILED"), ("a", 2, "COMPLETED"), ("b", 1, "COMPLETED"), ("b", 2, "FAILED"), ("c", 1, "RUNNING"), ("z", 1, "COMPLETED")],
        "checkpoint_key string, attempt int, status string")
    todo, reuse = copyplan.resume(units, seen)
    assert rows(todo) == [("b",), ("c",), ("d",)] and rows(reuse, "checkpoint_key") == [("a",)]


LOG = """PHASE_START listing
PHASE_END listing seconds=3
EDGE_HOST= n1
submitted application_1_7
PHASE_START copy
Container killed by x"""


def test_diagnose(spark):
    logs = spark.createDataFrame([
        ("open", LOG, None), ("copy", "DISTCP_EXIT_CODE=12\nDISTCP_EXIT_CODE=0", 1), ("script", "x", 3), ("lost", "x", None),
        ("after", "PHASE_START a\nPHASE_END a seconds=1", None), ("fine", "PHASE_START a\nPHASE_END a seconds=1\nDISTCP_EXIT_CODE=0", 0),
        ("killed", "", 137)], "unit string, log string, exit_code int")
    lines = copyplan.log_lines(logs, "unit", "log")
    got = {r["unit"]: r for r in copyplan.diagnose(lines, logs.select("unit", "exit_code"), "unit").collect()}
    assert {k: r["failure_phase"] for k, r in got.items()} == {
        "open": "copy", "copy": "distcp", "script": "script", "lost": "ssh_or_startup", "after": "after_script", "fine": None, "killed": "script"}
    assert got["open"]["application_id"] == "application_1_7" and got["open"]["submitted"] and got["open"]["edge_host"] == "n1"
    assert [k for k, r in sorted(got.items()) if r["memory_kill_suspected"]] == ["killed", "open"]


def test_unit_outcomes(spark):
    frame = spark.createDataFrame([
        (None, False, 0, 1, None), ("x", True, 1, 1, True), (None, True, 1, 0, True), (None, True, 0, 1, True), (None, True, 2, 1, False),
        (None, True, 2, None, True)], "e string, x boolean, f int, p int, ok boolean")
    out = [r[0] for r in frame.select(copyplan.unit_outcome("e", "x", "f", "p", "ok")).collect()]
    assert out == ["SOURCE_NOT_FOUND", "FAILED", "SKIPPED", "EMPTY_SOURCE", "FAILED", "COMPLETED"]


def test_overlaps(spark):
    data = [("a", "t1", "s3a://b/x"), ("a", "t2", "s3a://b/x/"), ("a", "t3", "s3a://b/x/y"), ("a", "t4", "s3a://b/xy"), ("a", "t4", "s3a://b/xy"),
            ("a", "t5", ""), ("a", "t6", "s3a://b/x/y/z")]
    frame = spark.createDataFrame(data, "db string, tbl string, dest string")
    got = rows(locations.overlaps(frame, ["db", "tbl"]), "tbl", "same", "above", "below", "nearest_above")
    assert got == [("t1", 1, 0, 2, None), ("t2", 1, 0, 2, None), ("t3", 0, 2, 1, "s3a://b/x"), ("t6", 0, 3, 0, "s3a://b/x/y")]
    assert rows(locations.overlap_pairs(frame)) == [
        ("s3a://b/x", "s3a://b/x/y"), ("s3a://b/x", "s3a://b/x/y/z"), ("s3a://b/x/y", "s3a://b/x/y/z")]


def test_source_relative_destination(spark):
    paths = spark.createDataFrame([("hdfs://n/data/app/t",), ("/data/appx/t",), ("/data/app",), (None,)], "path string")
    prefixes = spark.createDataFrame([("/data",), ("hdfs://n//data/app/",), ("/",), ("",)], "prefix string")
    out = locations.source_relative_destination(paths, prefixes, F.lit("s3a://b/")).collect()
    got = {r["path"]: (r["dest"], r["error"] is None) for r in out}
    assert got == {"hdfs://n/data/app/t": ("s3a://b/t", True), "/data/appx/t": ("s3a://b/appx/t", True), "/data/app": (None, False),
                   None: (None, False)}


CATALOG = [("d", "red_ring"), ("d", "Red_Bolt"), ("d", "ab"), ("d", "a"), ("e", "red_x"), ("d", "old_backup_")]


@pytest.mark.parametrize("token, expected", [
    ("*", ["Red_Bolt", "a", "ab", "old_backup_", "red_ring"]), ("red_*", ["Red_Bolt", "red_ring"]), ("*_BOLT", ["Red_Bolt"]),
    ("RED_BOLT", ["Red_Bolt"]), ("?", ["a"]), ("??", ["ab"]), ("*d_r*", ["red_ring"]), ("r?d_?olt", ["Red_Bolt"]), ("*b", ["ab"]),
    ("none*", []), ("red.ring", []), ("a*", ["a", "ab"]), ("*a*", ["a", "ab", "old_backup_"]),
])
def test_match_tokens(spark, token, expected):
    catalog = spark.createDataFrame(CATALOG, "db string, tbl string")
    toks = spark.createDataFrame([("d", token)], "db string, token string")
    assert sorted(r["tbl"] for r in tokens.match_tokens(toks, catalog).collect()) == expected


def test_resolve_tables(spark):
    catalog = spark.createDataFrame(CATALOG, "db string, tbl string")
    manifest = spark.createDataFrame(
        [("d", "include", "red_*"), ("d", "include", "AB"), ("d", "include", "gone"), ("d", "include", "out"), ("d", "exclude", "ou*"),
         ("d", "exclude", "RED_RING"), ("q", "include", "x"), ("q", "include", "*")], "db string, role string, token string")
    found, missing = tokens.resolve_tables(manifest, catalog)
    assert rows(found) == [("d", "Red_Bolt"), ("d", "ab")]
    assert rows(missing) == [("d", "gone", "TABLE_NOT_FOUND"), ("q", "*", "DATABASE_NOT_FOUND"), ("q", "x", "DATABASE_NOT_FOUND")]
    unmatched = tokens.unmatched_tokens(manifest.where("db = 'd'"), catalog)
    assert rows(unmatched) == [("d", "gone"), ("d", "ou*"), ("d", "out")]


def test_group_manifest(spark):
    sheet = spark.createDataFrame([
        (1, "d", "b, a", "", "s3://x", None, None), (2, "d", "a,c", None, "s3://x", "nan", None), (3, "d", "exclude: z ,y", "d", "s3://x", None, None),
        (4, "e", "Exclude: q", "", "", None, None), (5, "f", None, "", "k", "dt=1", None), (6, "", "t", "", "", None, None),
        (7, "f", "t1", "", "k", "dt=1", None)],
        "row_index long, database string, table string, dest_database string, bucket string, partition_filter string, endpoint string")
    out = tokens.group_manifest(tokens.normalise_manifest(sheet, "s3a://dflt"))
    got = [tuple(r) for r in out.orderBy("src_db", "role", "first_row", "first_pos").select("src_db", "bucket", "partition_filter", "role", "token").collect()]
    assert got == [
        ("d", "s3a://x", "", "exclude", "z"), ("d", "s3a://x", "", "exclude", "y"), ("d", "s3a://x", "", "include", "b"), ("d", "s3a://x", "", "include", "a"),
        ("d", "s3a://x", "", "include", "c"), ("e", "s3a://dflt", "", "exclude", "q"), ("e", "s3a://dflt", "", "include", "*"),
        ("f", "s3a://k", "dt=1", "include", "*")]


def test_conversion_rows(spark):
    sheet = spark.createDataFrame([(1, "d", None, "T", None), (2, "d", "a,b", None, ""), (3, "d", "a", "maybe", None), (4, "", "a", "F", None), (5, "d", "a", "no", "x")],
                                  "row_index long, database string, table string, inplace_migration string, destination_iceberg_database string")
    valid, rejected = tokens.conversion_rows(sheet)
    assert rows(valid, "row_index", "table_cell", "in_place", "dest_db") == [(1, "*", True, "d"), (2, "a,b", False, "d_iceberg"), (5, "a", False, "x")]
    assert rows(rejected, "row_index", "reason") == [(3, "invalid in-place flag"), (4, "missing database")]


def test_folder_rows(spark):
    sheet = spark.createDataFrame([(1, "/data/in/", "s3: bkt", None, None, "yes"), (2, "/d", "nan", None, None, None), (3, None, "b", None, None, None), (4, "/d/x", "b/y", "y", "e", "what")],
                                  "row_index long, source_path string, target_bucket string, dest_folder string, endpoint string, split_subfolders string")
    valid, rejected = tokens.folder_rows(sheet)
    assert rows(valid, "dest_bucket", "dest_folder", "endpoint", "split_subfolders") == [("s3a://b", "y", "e", False), ("s3a://bkt", "in", "", True)]
    assert rows(rejected, "row_index", "reason") == [(2, "missing target_bucket"), (3, "missing source_path")]


def test_catalog_move_rows(spark):
    sheet = spark.createDataFrame([(1, "d", "a,b", "s3://o/", "s3n://n/"), (2, "d", "a", None, "n"), (3, "d", "*", "s3a://o", "s3a://n"), (4, "d", "x", "o", " ")],
                                  "row_index long, database string, table string, source_s3_prefix string, dest_s3_prefix string")
    valid, rejected = tokens.catalog_move_rows(sheet)
    assert rows(rejected, "row_index", "reason") == [(4, "missing dest_s3_prefix")]
    grouped = tokens.group_manifest(valid, keys=tokens.MOVE_KEYS)
    assert rows(grouped, "source_prefix", "dest_prefix", "token") == [("s3a://n", "s3a://n", "a"), ("s3a://o", "s3a://n", "*")]
