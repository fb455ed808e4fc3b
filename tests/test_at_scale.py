"""Rare anchors, interned lists, tree packing, large rule sets and sheets in pieces, against plain loops."""

import csv
import fnmatch
import io
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from tablekit.operators import copyplan, policy, textscan, tokens
from tablekit.operators.textscan import Rule
from tablekit.plans.tracking import small_pieces
from tablekit.sources import sheets


def test_globs_against_every_name(spark):
    rng = random.Random(1)
    names = sorted({"".join(rng.choice("abc_1^$") for _ in range(rng.randint(1, 9))) for _ in range(400)} | {"x", "long_table_name", "long_table_same"})
    globs = ["*", "?", "??", "a*", "*a", "*ab*", "a?b*", "*_1*", "^*", "*$", "abc", "long*name", "*table*", "?ong_*_s*", "zzz*", "*b?c*", "a**b", "*?"]
    frame = spark.createDataFrame([("d", n) for n in names] + [("e", n) for n in names[:50]], "db string, tbl string")
    toks = spark.createDataFrame([("d", g) for g in globs] + [("e", "a*"), ("e", "*"), ("none", "*")], "db string, token string")
    got = {tuple(r) for r in tokens.match_tokens(toks, frame).collect()}

    def fits(name, glob):
        return re.fullmatch("".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in glob), name) is not None

    want = {("d", g, n) for g in globs for n in names if fits(n, g)}
    want |= {("e", g, n) for g in ("a*", "*") for n in names[:50] if fits(n, g)}
    assert got == want


def test_hot_anchors_are_cut(spark, monkeypatch):
    monkeypatch.setattr(tokens, "_PIECE", 10)
    names = spark.range(500).select(F.lit("d").alias("db"), F.concat(F.lit("red_"), F.col("id").cast("string")).alias("tbl"))
    toks = spark.createDataFrame([("d", "red_*"), ("d", "*d_1*"), ("d", "red_?")], "db string, token string")
    got = tokens.match_tokens(toks, names).groupBy("token").agg(F.count("*").alias("n"), F.count_distinct("tbl").alias("m"))
    want = {g: sum(fnmatch.fnmatch(f"red_{i}", g) for i in range(500)) for g in ("red_*", "*d_1*", "red_?")}
    assert {r["token"]: (r["n"], r["m"]) for r in got.collect()} == {g: (n, n) for g, n in want.items()}


def test_only_used_anchors_are_taken_apart(spark):
    names = spark.createDataFrame([("d", "abcdefghij", "abcdefghij")], "db string, tbl string, _name string")
    used = spark.createDataFrame([(3, "cde")], "_long int, a string").select(
        "_long", tokens._slot(F.lit("d"), "a").alias("slot")).groupBy("_long", F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS INT))")).alias("bits")).collect()
    assert names.select(tokens._used_anchors("_name", used).alias("a")).first()["a"] == ["cde"]


def plain_first_fit(costs, cap, most, counts):
    room, free, out = [], [], []
    for need, number in zip(costs, counts):
        j = next((k for k in range(len(room)) if room[k] >= need and free[k] >= number), len(room)) if need <= cap else len(room)
        if j == len(room):
            room.append(cap)
            free.append(most)
        room[j] -= need
        free[j] -= number
        out.append(j)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_tree_first_fit_against_a_list(seed):
    rng = np.random.default_rng(seed)
    costs = np.sort(rng.choice([0.0, 0.5, 1.0, 2.5, 7.0, 12.0], 300) + rng.integers(0, 3, 300))[::-1]
    counts = np.ones(300, int) if seed % 2 else rng.integers(1, 4, 300)
    got = copyplan.first_fit(costs, 10.0, 5, counts if seed % 2 == 0 else None)
    assert got.tolist() == plain_first_fit(costs.tolist(), 10.0, 5, counts.tolist())
    assert copyplan.first_fit(np.array([]), 1.0, 5).tolist() == []


def test_one_database_is_packed_by_several_tasks(spark):
    tables = spark.range(3000).select(F.lit("d").alias("db"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("tbl"),
                                      (F.pmod(F.xxhash64("id"), F.lit(97)) + 1.0).alias("cost")).unionByName(
        spark.createDataFrame([("e", "big", 500.0), ("e", "nothing", 0.0)], "db string, tbl string, cost double"))
    out = copyplan.pack_batches(tables, 100.0, 25, shard_tables=200)
    found = out.collect()
    assert sorted((r["db"], r["tbl"]) for r in found) == sorted((r["db"], r["tbl"]) for r in tables.collect())
    batches = {}
    for r in found:
        batches.setdefault(r["batch"], []).append(r)
    assert len({b.split("/")[1] for b in batches if b.startswith("d/")}) > 5
    for members in batches.values():
        cost = sum(m["cost"] for m in members)
        assert len({m["db"] for m in members}) == 1 and len(members) <= 25 and (cost <= 100 + 1e-6 or len(members) == 1)
        assert {m["batch_tables"] for m in members} == {len(members)} and all(abs(m["batch_cost"] - cost) < 1e-6 for m in members)
    half = [b for b, m in batches.items() if b.startswith("d/") and sum(x["cost"] for x in m) <= 50 and len(m) <= 12]
    assert len(half) <= 1  # what the shards left half empty went together


def test_equal_lists_are_kept_once(spark):
    people = spark.createDataFrame([(p, f"pol{i}", f"id{i}") for p in ("ann", "bob", "cy") for i in range(3)] + [("dee", "pol1", "id1")],
                                   "_name string, policy_name string, policy_id string")
    lists, members = policy._interned(people)
    assert rows(lists) == [("ann", "ann"), ("bob", "ann"), ("cy", "ann"), ("dee", "dee")]
    assert members.count() == 4


def test_spreading_hands_on_names_only(spark, monkeypatch):
    written = {}
    plain = policy.materialize

    def watching(df, label="stage"):
        out = plain(df, label)
        written[label] = out.count()
        return out

    monkeypatch.setattr(policy, "materialize", watching)
    applied = spark.range(200).select(F.concat(F.lit("pol"), F.col("id").cast("string")).alias("policy_name"),
                                      F.col("id").cast("string").alias("policy_id"), F.lit("everyone").alias("principal"))
    objects = spark.range(100).select(F.lit("mapping").alias("object_type"), F.concat(F.lit("r"), F.col("id").cast("string"), F.lit("->everyone (group)")).alias(
        "object_name"), F.lit("").alias("policy_name"), F.lit("").alias("policy_id"))
    objects = objects.unionByName(spark.range(100).select(F.lit("role").alias("object_type"), F.concat(F.lit("r"), F.col("id").cast("string")).alias(
        "object_name"), F.lit("").alias("policy_name"), F.lit("").alias("policy_id")))
    out = policy.spread_ids(objects, applied)
    assert out.count() == 200 * 200
    assert max(written.values()) <= 200


def test_own_values_are_handed_on(spark):
    objects = spark.createDataFrame(
        [("mapping", "r1->ann (group)", "mine", "7"), ("mapping", "r1->bob (group)", "", ""), ("role", "r1", None, None), ("ranger_group", "r1", "", None),
         ("keycloak_group", "ann", "", ""), ("role", "lonely", "", "x"), ("other", "o", "a", "b")],
        "object_type string, object_name string, policy_name string, policy_id string")
    applied = spark.createDataFrame([("p1", "1", "bob"), ("p2", "2", "bob")], "policy_name string, policy_id string, principal string")
    got = {(r[0], r[1], r[2], r[3]) for r in policy.spread_ids(objects, applied).collect()}
    both = [("mine", "7"), ("p1", "1"), ("p2", "2")]
    assert got == ({("mapping", "r1->ann (group)", "mine", "7"), ("role", "lonely", "", "x"), ("other", "o", "a", "b"), ("keycloak_group", "ann", "mine", "7")}
                   | {("mapping", "r1->bob (group)", n, i) for n, i in both[1:]} | {(t, "r1", n, i) for t in ("role", "ranger_group") for n, i in both})


def test_literals_of_rules():
    def literal(pattern, **more):
        return textscan.required_literal(Rule("R", pattern, **more))

    assert literal(r"\bfrom airflow\.operators import (a|b)") == "from airflow.operators import "
    assert literal(r"(abc|abd)x") == "" and literal(r"ab?cd") == "cd" and literal(r"(?:foo)+") == ""
    assert literal(r"[0-9]+", needs="Key") == "key" and literal(r"HELLO\s+World") == "hello"


def test_large_rule_sets_against_every_rule(spark):
    rng = random.Random(2)
    parts = ["alpha", "Beta", "gamma", "d_e", "zeta", "eta"]
    rules = [Rule(f"R{i}", rf"{rng.choice(parts)}\s*{rng.choice(parts)}", ignore_case=i % 3 == 0, endings=(".py",) if i % 2 else (".py", ".sql"),
                  code_only=i % 5 == 0) for i in range(120)] + [Rule("FREE", r"[0-9]{3}", endings=(".py",))]
    lines = [(f"f{i % 4}.{'py' if i % 3 else 'sql'}", i, " ".join(rng.choice([*parts, "ALPHA", "123", ""]) for _ in range(5)), i % 7 != 0) for i in range(150)]
    lines += [("f.py", 500, "", True), ("f.py", 501, None, True)]
    frame = spark.createDataFrame(lines, "path string, line_no int, line string, is_code boolean")
    assert rows(textscan.scan_by_literals(frame, rules)) == rows(textscan.scan_lines(frame, rules))


def test_equal_rows_of_a_file_keep_their_line_numbers(spark):
    frame = spark.createDataFrame([("a.py", "x\nfoo\nbar\n")] * 2, "path string, text string")
    found = textscan.scan_multiline(frame, [Rule("M", r"foo\nbar", endings=(".py",), multiline=True)])
    assert rows(found, "line_no") == [(2,), (2,)]


HEAD = ["Database", "Table ", "Dest Database", "bucket"]


def sheet_rows(rng, n):
    cells = ["plain", "", "with, comma", 'a "quote"', "two\nlines", "\n", 'x"\n"y', "a\n\n\nb,\"c\"", " lead", "5' wide", "é\n漢字", "\"", ",\n,"]
    return [[rng.choice(cells) for _ in range(3)] + ["b"] for _ in range(n)]


@pytest.mark.parametrize("size", ["300b", "128m"])
def test_sheets_in_pieces_are_read_as_by_one_task(spark, tmp_path, size):
    rng = random.Random(size)
    folder = tmp_path / "sheets"
    folder.mkdir()
    want = []
    for name, ending in (("a.csv", "\n"), ("b.csv", "\r\n"), ("c.csv", "\n")):
        data = sheet_rows(rng, 60)
        out = io.StringIO()
        csv.writer(out, lineterminator=ending).writerows([HEAD, *data])
        (folder / name).write_text(out.getvalue(), newline="")
        want += data
    (folder / "d.csv").write_text('Database,Table ,Dest Database,bucket\nx,5" pipe,un"quoted,b\n\n"last",t,,b', newline="")
    want += [["x", '5" pipe', 'un"quoted', "b"], ["last", "t", "", "b"]]
    with small_pieces(spark, size):
        got = sheets.read_manifest(spark, str(folder), "table_copy").orderBy("row_index").collect()
    assert [[r["database"], r["table"], r["dest_database"], r["bucket"]] for r in got] == [[c or None for c in r] for r in want]
    plain = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(folder / "a.csv"))
    assert [tuple(r) for r in plain.collect()] == [(r["database"], r["table"], r["dest_database"], r["bucket"]) for r in got[:60]]


def test_sheets_without_rows(spark, tmp_path):
    (tmp_path / "s.csv").write_text("database,table,dest_database,bucket\n")
    assert sheets.read_manifest(spark, str(tmp_path / "s.csv"), "table_copy").count() == 0
