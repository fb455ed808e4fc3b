import ast
import re

import pytest

from helpers import rows
from tablekit.operators import textscan as t
from tablekit.operators.textscan import Fix, Rule
from tablekit.rules import spark_upgrade_rules, workflow_moves, workflow_removals, workflow_renames

SOURCE = '"""doc red\n"""\n\nx = 1  # red\n# red comment\ndef f(\n    a,\n):\n    return "red"\n'


def files(spark, **texts):
    return spark.createDataFrame([(k.replace("__", "/").replace("_", "."), v) for k, v in texts.items()], "path string, text string")


@pytest.mark.parametrize("text", ["a\nb", "a\nb\n", "a\n\n", "\n", "a\r\nb\rc", "a\x0bb\x1cc\u2028d\x85", "", "a"])
def test_lines_are_those_of_splitlines(spark, text):
    frame = spark.createDataFrame([("p", text)], "path string, text string")
    got = [r["line"] for r in t.file_lines(frame).orderBy("line_no").collect()]
    assert got == text.splitlines()


def test_strip_is_pythons(spark):
    text = " \t\u3000x \xa0y\x1f\n"
    frame = spark.createDataFrame([(text,)], "line string")
    assert frame.select(t.strip("line")).first()[0] == text.strip()


def test_scan_lines(spark):
    rules = [Rule("A", r"red\d", needs="red"), Rule("B", r"RED", ignore_case=True, needs="Red"), Rule("C", "x", endings=(".sql",))]
    lines = t.file_lines(files(spark, a_py="  red1 x\nRed\nnone", b_sql="x\nred1"))
    assert rows(t.scan_lines(lines, rules), "path", "rule_id", "line_no", "excerpt") == [
        ("a.py", "A", 1, "red1 x"), ("a.py", "B", 1, "red1 x"), ("a.py", "B", 2, "Red"), ("b.sql", "A", 2, "red1"), ("b.sql", "B", 2, "red1"), ("b.sql", "C", 1, "x")]
    long = t.scan_lines(t.file_lines(files(spark, a_py="red1" + "y" * 500)), rules[:1]).first()
    assert len(long["excerpt"]) == 504


def test_multiline_matches_brute_force(spark):
    texts = {"a_py": "foo(\n 1)\nx\nfoo(2) foo(\n3)", "b_py": "é\nfoo(\n)" * 3, "c_txt": "foo()"}
    rule = Rule("M", r"foo\(.*?\)", multiline=True)
    want = set()
    for name, text in texts.items():
        if name.endswith("py"):
            for m in re.finditer(rule.pattern, text, re.S):
                want.add((name.replace("_", "."), text.count("\n", 0, m.start()) + 1))
    got = t.one_per_line(t.scan_multiline(files(spark, **texts), [rule]))
    assert {(r["path"], r["line_no"]) for r in got.collect()} == want
    big = "x\n" * 700_000 + "foo(\n1)"
    assert [r["line_no"] for r in t.scan_multiline(files(spark, a_py=big), [rule]).collect()] == [700_001]
    with pytest.raises(ValueError):
        t.scan_multiline(files(spark, **texts), [Rule("E", "x*", multiline=True)])


def test_line_pass_goes_first(spark):
    found = t.scan(files(spark, a_py="go(\n1)"), [Rule("A", r"go\("), Rule("B", r"go\(.*?\)", multiline=True)])
    assert rows(found, "rule_id", "line_no", "pass", "excerpt") == [("A", 1, 1, "go("), ("B", 1, 2, "go( 1)")]


def test_code_lines(spark):
    want = set()
    for node in ast.walk(ast.parse(SOURCE)):
        if hasattr(node, "lineno"):
            want |= set(range(node.lineno, node.end_lineno + 1))
    lines = t.mark_code(files(spark, a_py=SOURCE, bad_py="def (\n# red", c_sql="-- red"))
    got = {(r["path"], r["line_no"]): r["is_code"] for r in lines.collect()}
    assert {n for (p, n), code in got.items() if p == "a.py" and code} == want
    assert got["bad.py", 2] and got["c.sql", 1]
    found = t.scan(files(spark, a_py=SOURCE), [Rule("R", "red", code_only=True), Rule("S", "red")])
    assert rows(found.where("rule_id = 'R'"), "line_no") == [(1,), (4,), (9,)]
    assert rows(found.where("rule_id = 'S'"), "line_no") == [(1,), (4,), (5,), (9,)]


def test_rules(tmp_path):
    rules = t.load_rules('[{"rule_id": "A", "pattern": "x", "severity": "high", "category": "c", "endings": [".py"]}, {"rule_id": "B", "pattern": "y", "severity": "info"}]')
    assert [r.rule_id for r in t.pick_rules(rules, "medium")] == ["A"] and [r.rule_id for r in t.pick_rules(rules, categories=["general"])] == ["B"]
    for bad in ([Rule("A", "("),], [Rule("A", "x"), Rule("A", "y")], [Rule("A", "x", severity="worst")]):
        with pytest.raises((ValueError, re.error)):
            t.check_rules(bad)


def test_scannable(spark):
    paths = ["a/b.py", "a/build/b.py", ".git/x.py", "a/b.txt", "x.pyc", "a/rebuild/b.sql"]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    assert rows(frame.where(t.scannable("path"))) == [("a/b.py",), ("a/rebuild/b.sql",)]


def test_summary_and_totals(spark):
    source = files(spark, a_py="red\nred", b_py="blue")
    rules = [Rule("R", "red", "high", "colour")]
    lines = t.file_lines(source)
    found = t.scan(source, rules)
    assert rows(t.summarise(found)) == [("category", "colour", 2), ("path", "a.py", 2), ("rule_id", "R", 2), ("severity", "high", 2)]
    assert tuple(t.scan_totals(lines, found).select("files_scanned", "lines_scanned", "files_with_issues", "issues").first()) == (2, 3, 1, 2)
    assert tuple(t.line_totals(lines, rules).select("files_scanned", "lines_scanned", "files_with_issues", "issues").first()) == (2, 3, 1, 2)
    none = t.scan_totals(lines, found.limit(0)).select("files_scanned", "files_with_issues", "issues").first()
    assert tuple(none) == (2, 0, 0)


FIXES = [
    Fix("I1", r"from old import (\w+)", r"from new import $1", family="import", whole_line=True),
    Fix("I2", r"from old import", r"never", family="import", whole_line=True),
    Fix("D1", r"\bdummy\b", "empty", needs="dummy"),
    Fix("M1", r"gone\(", "MANUAL(", fixable=False),
]


def test_fixes(spark):
    source = files(spark, a_py="from old import x  # c\n  y = dummy(dummy)\n# dummy\n\ngone(1)\nfrom old import dummy", b_py="fine")
    found = t.suggest_fixes(t.file_lines(source), FIXES)
    assert rows(found, "line_no", "rule_id", "new_code", "fixable") == [
        (1, "I1", "from new import x", True), (2, "D1", "y = empty(empty)", True), (5, "M1", "MANUAL(1)", False), (6, "D1", "from old import empty", True),
        (6, "I1", "from new import dummy", True)]
    first = t.first_fix_per_line(found)
    done = t.fixed_files(source, first).collect()
    assert [(r["path"], r["text"], r["applied"]) for r in done] == [
        ("a.py", "from new import x\n  y = empty(empty)\n# dummy\n\ngone(1)\nfrom new import dummy\n", 3)]
    stale = first.replace("y = dummy(dummy)", "other", ["old_code"])
    changed = t.apply_fixes(t.file_lines(source), stale).where("path = 'a.py'").orderBy("line_no").collect()
    assert [r["applied"] for r in changed] == [True, False, False, False, False, True] and changed[1]["line"] == "  y = dummy(dummy)"


def test_moved_imports(spark):
    text = ("from airflow.decorators import dag, task as t\nfrom airflow import DAG\n  from airflow.operators.python import (PythonOperator, x)  # c\n"
            "from airflow.utils.dates import days_ago\nfrom mine import Dataset\n# from airflow import DAG\nx = 1\nimport airflow\n")
    found = t.moved_imports(t.file_lines(files(spark, a_py=text)), workflow_moves(spark))
    sdk, python = "airflow.sdk", "airflow.providers.standard.operators.python"
    assert set(rows(found, "line_no", "name", "new_module", "new_name")) >= {
        (1, "dag", sdk, "dag"), (1, "task", sdk, "task"), (2, "DAG", sdk, "DAG"), (3, "PythonOperator", python, "PythonOperator"),
        (3, "x", python, "x"), (4, "days_ago", None, None)}
    assert {r["line_no"] for r in found.collect()} == {1, 2, 3, 4}


@pytest.mark.parametrize("line, new", [
    ("    schedule_interval='@daily',", "schedule='@daily',"),
    ("x = context['execution_date']", "x = context['logical_date']"),
    ("t = DummyOperator(task_id='x')", "t = EmptyOperator(task_id='x')"),
    ("rule = TriggerRule.DUMMY", "rule = TriggerRule.ALWAYS"),
    ("d = Dataset('x')", "d = Asset('x')"),
    ("my_schedule_interval = 1", None),
])
def test_renamed_identifiers(spark, line, new):
    found = t.suggest_fixes(t.file_lines(files(spark, a_py=line)), workflow_renames()).collect()
    assert [r["new_code"] for r in found] == ([new] if new else [])


def test_removed_context_is_only_reported(spark):
    found = t.suggest_fixes(t.file_lines(files(spark, a_py="x = context.get('prev_ds')")), workflow_removals())
    assert rows(found, "rule_id", "fixable") == [("GONE-prev_ds", False)]


def test_shipped_rules_work_together(spark):
    source = files(spark, a_py="df = sqlContext.sql('x')\ndf.registerTempTable(\n 't')\nfor k in d.iteritems(): pass\n# udf(\n", b_py="print 'x'\n")
    found = t.scan(source, spark_upgrade_rules())
    assert rows(found, "path", "line_no", "rule_id") == [
        ("a.py", 1, "API-SQLCONTEXT"), ("a.py", 2, "API-TEMPTABLE"), ("a.py", 4, "PY2-ITER"), ("b.py", 1, "PY2-PRINT")]
