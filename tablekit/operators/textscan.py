"""Rules over text: line scan, multi-line scan, code lines, summaries, suggested and applied fixes.

Rules are a short list known to the driver, so they become one expression per file or line; files and
lines are rows. There is no join of lines with rules.
"""

from __future__ import annotations

import ast
import json
import re
import warnings
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Severities from worst to mildest.
SEVERITIES = ("critical", "high", "medium", "low", "info")
# File name endings that are scanned, and names that are left out.
SCANNED_ENDINGS = (".py", ".scala", ".java", ".sql", ".conf", ".properties", ".xml", ".yaml", ".yml", ".sbt",
                   ".gradle", ".hql")
RULE_ENDINGS = (".py", ".scala", ".java", ".sql", ".conf", ".properties", ".xml", ".yaml", ".yml")
SKIPPED_NAMES = ("__pycache__", ".git", "node_modules", ".venv", "venv", "target", "build", "dist", ".idea",
                 ".vscode", "*.pyc")
ISSUE_DDL = "path string, rule_id string, line_no int, excerpt string, pass int"


@dataclass(frozen=True)
class Rule:
    """One pattern to look for. Patterns are limited to what Java and Python regexes share."""

    rule_id: str
    pattern: str
    severity: str = "medium"
    category: str = "general"
    title: str = ""
    suggestion: str = ""
    endings: tuple[str, ...] = RULE_ENDINGS
    multiline: bool = False
    code_only: bool = False
    ignore_case: bool = False
    needs: str = ""  # text every match contains; lets other lines skip the pattern

    def java(self) -> str:
        return ("(?i)" if self.ignore_case else "") + self.pattern


def load_rules(text: str) -> list[Rule]:
    """Rules from a JSON list of objects."""
    rules = [Rule(**{**r, "endings": tuple(r.get("endings", RULE_ENDINGS))}) for r in json.loads(text)]
    return check_rules(rules)


def check_rules(rules: list[Rule]) -> list[Rule]:
    """Refuse bad patterns, repeated ids, unknown severities and multi-line patterns that match nothing at all."""
    if len({r.rule_id for r in rules}) != len(rules):
        raise ValueError("rule ids must be unique")
    for rule in rules:
        if rule.severity not in SEVERITIES:
            raise ValueError(f"unknown severity {rule.severity!r} in {rule.rule_id}")
        if re.compile(rule.pattern).match("") and rule.multiline:
            raise ValueError(f"{rule.rule_id} matches the empty text")
    return rules


def pick_rules(rules: list[Rule], min_severity: str | None = None, categories: list[str] | None = None) -> list[Rule]:
    """Rules at least as severe as asked for, in the asked categories."""
    worst = SEVERITIES.index(min_severity) if min_severity else len(SEVERITIES)
    return [r for r in rules if SEVERITIES.index(r.severity) <= worst and (not categories or r.category in categories)]


def scannable(path: Column | str, endings=SCANNED_ENDINGS, skipped=SKIPPED_NAMES) -> Column:
    """True for paths with a scanned ending and no skipped folder or file name in them."""
    path = F.col(path) if isinstance(path, str) else path
    names = F.split(path, "/")
    exact = [s for s in skipped if not s.startswith("*")]
    skip = F.exists(names, lambda n: n.isin(*exact))
    endings_skipped = [s[1:] for s in skipped if s.startswith("*")]
    if endings_skipped:
        skip = skip | F.exists(names, lambda n: _ends_with(n, endings_skipped))
    return _ends_with(path, endings) & ~skip


def _ends_with(path: Column, endings) -> Column:
    hit = F.lit(False)
    for ending in endings:
        hit = hit | path.endswith(ending)
    return hit


# Line breaks and white space as Python's splitlines and strip know them.
LINE_BREAK = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x85\u2028\u2029]"
RARE_BREAKS = ("\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029")
SPACE = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
         "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
INDENT = r"(?U)^\s*"


def strip(line: Column | str) -> Column:
    return F.btrim(line, F.lit(SPACE))


def split_lines(text: Column | str) -> Column:
    """Pieces of a text between line breaks; text that ends with a break has an empty last piece.

    Texts whose only break is the line feed, nearly all, take the plain split.
    """
    text = F.col(text) if isinstance(text, str) else text
    rare = F.lit(False)
    for mark in RARE_BREAKS:
        rare = rare | text.contains(mark)
    return F.when(rare, F.split(text, LINE_BREAK)).otherwise(F.split(text, "\n"))


def file_lines(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, line_no from 1, line) of every line of every file; a final break opens no further line."""
    keep = [c for c in files.columns if c not in (path, text)]
    # The outer form keeps the optimizer from testing the array's size first, which would split twice.
    pieces = files.where(F.coalesce(F.col(text), F.lit("")) != "").select(
        path, *keep, split_lines(text).alias("_lines"))
    rows = pieces.select(path, *keep, F.size("_lines").alias("_n"), F.posexplode_outer("_lines").alias("_pos", "line"))
    rows = rows.where((F.col("line") != "") | (F.col("_pos") < F.col("_n") - 1))
    return rows.select(path, *keep, (F.col("_pos") + 1).cast("int").alias("line_no"), "line")


def scan_lines(lines: DataFrame, rules: list[Rule], path: str = "path") -> DataFrame:
    """Issues of the single-line rules: one row per line and matching rule.

    Rules are one array expression over the line, so a line is read once whatever their number, and the
    text a rule ``needs`` keeps most lines away from its pattern. A
    ``code_only`` rule needs the line's ``is_code`` flag when the lines carry one.
    """
    tests = _line_tests(lines, rules, path)
    if not tests:
        return lines.sparkSession.createDataFrame([], ISSUE_DDL)
    hits = F.array_compact(F.array(*tests))
    return lines.where(F.coalesce(*tests).isNotNull()).select(
        F.col(path).alias("path"), F.explode_outer(hits).alias("rule_id"), "line_no",
        strip("line").alias("excerpt"), F.lit(1).alias("pass"))


def scan_by_literals(lines: DataFrame, rules: list[Rule], path: str = "path") -> DataFrame:
    """The issues of ``scan_lines`` for rule sets of any size.

    One automaton over the literals that the rules' matches must contain says which rules a line can match at all, and
    only those patterns are tried. Its cost is that of reading the line once, whatever the number of rules. Rules
    without such a literal are tried on every line.
    """
    rules = [r for r in check_rules(rules) if not r.multiline]
    free = [r for r in rules if not required_literal(r)]
    held = [r for r in rules if required_literal(r)]
    found = scan_lines(lines, free, path)
    if not held:
        return found
    has_code = "is_code" in lines.columns
    slim = lines.select(F.col(path).alias("path"), "line_no", "line",
                        (F.coalesce("is_code", F.lit(True)) if has_code else F.lit(True)).alias("is_code"))
    candidates = slim.mapInArrow(_candidates([required_literal(r) for r in held]),
                                 "path string, line_no int, line string, is_code boolean, rule int")
    rows = [(i, r.rule_id, r.java(), list(r.endings), r.code_only) for i, r in enumerate(held)]
    table = lines.sparkSession.createDataFrame(
        rows, "rule int, rule_id string, pattern string, endings array<string>, code_only boolean")
    tried = candidates.join(F.broadcast(table), "rule").where(  # as many rows as the driver holds rules
        F.exists("endings", lambda e: F.endswith(F.col("path"), e)) & (~F.col("code_only") | F.col("is_code"))
        & F.rlike("line", F.col("pattern")))
    return found.unionByName(tried.select("path", "rule_id", "line_no", strip("line").alias("excerpt"), F.lit(1).alias("pass")))


def _candidates(literals: list[str]):
    """Rows (path, line_no, line, is_code, rule) for each line and each rule whose literal it has, letter case aside."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        by_text: dict[str, list[int]] = {}
        for i, text in enumerate(literals):
            by_text.setdefault(text, []).append(i)
        automaton = ahocorasick.Automaton()
        for text, owners in by_text.items():
            automaton.add_word(text, owners)
        automaton.make_automaton()
        for batch in batches:
            at, rule = [], []
            for i, line in enumerate(batch.column("line").to_pylist()):
                hit = {o for _, owners in automaton.iter(_lower(line)) for o in owners} if line else ()
                at += [i] * len(hit)
                rule += sorted(hit)
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(rule, pa.int32())],
                                             names=["path", "line_no", "line", "is_code", "rule"])

    return find


def _lower(text: str) -> str:
    """ASCII letters in lower case, the only ones that Java's case-insensitive patterns fold."""
    return text.translate(_ASCII_LOWER)


_ASCII_LOWER = {ord(a): ord(a.lower()) for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def required_literal(rule: Rule) -> str:
    """A text, ASCII letters in lower case, that every match of a rule contains: what it ``needs``, else the longest run of
    characters that its pattern has outside of choices and optional parts; '' if there is none of two or more."""
    return _lower(_held(rule))


def _held(rule: Rule) -> str:
    if rule.needs:
        return rule.needs
    runs, run = [], []
    for op, value in re._parser.parse(rule.pattern):
        if str(op) == "LITERAL":
            run.append(chr(value))
            continue
        runs.append("".join(run))
        run = []
    best = max([*runs, "".join(run)], key=len)
    return best if len(best) > 1 else ""


def line_totals(lines: DataFrame, rules: list[Rule], path: str = "path") -> DataFrame:
    """Files and lines scanned, files with issues, and issues of the single-line rules, in one pass over the lines."""
    tests = _line_tests(lines, rules, path)
    found = F.size(F.array_compact(F.array(*tests))) if tests else F.lit(0)
    per_file = lines.groupBy(path).agg(F.count(F.lit(1)).alias("_lines"), F.sum(found).alias("_n"))
    return per_file.agg(
        F.count(F.lit(1)).alias("files_scanned"), F.coalesce(F.sum("_lines"), F.lit(0)).alias("lines_scanned"),
        F.count_if(F.col("_n") > 0).alias("files_with_issues"), F.coalesce(F.sum("_n"), F.lit(0)).alias("issues"))


def _line_tests(lines: DataFrame, rules: list[Rule], path: str) -> list[Column]:
    """The id of each single-line rule where it matches the line, else NULL."""
    rules = [r for r in check_rules(rules) if not r.multiline]
    has_code = "is_code" in lines.columns
    tests = []
    for rule in rules:
        test = _holds(F.col("line"), rule.needs, rule.ignore_case) & _ends_with(F.col(path), rule.endings)
        test = test & F.col("line").rlike(rule.java())
        if rule.code_only and has_code:
            test = test & F.coalesce("is_code", F.lit(True))
        tests.append(F.when(test, F.lit(rule.rule_id)))
    return tests


def _holds(line: Column, needed: str, ignore_case: bool = False) -> Column:
    if not needed:
        return F.lit(True)
    return F.lower(line).contains(needed.lower()) if ignore_case else line.contains(needed)


def scan_multiline(files: DataFrame, rules: list[Rule], path: str = "path", text: str = "text") -> DataFrame:
    """Issues of the multi-line rules, whose dot also matches line breaks, over whole texts.

    A match starts after the line feeds of the pieces up to it and of the matches before it. Matches and pieces become
    rows, and their line feeds are added up per file and rule.
    """
    rules = [r for r in check_rules(rules) if r.multiline]
    if not rules:
        return files.sparkSession.createDataFrame([], ISSUE_DDL)
    slim = files.where(F.col(text).isNotNull()).select(  # equal rows stay apart
        F.col(path).alias("path"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("file"))
    found = []
    for rule in rules:
        pattern = f"(?s{'i' if rule.ignore_case else ''})(?:{rule.pattern})"
        hit = _ends_with(F.col("path"), rule.endings) & _holds(F.col("text"), _held(rule), rule.ignore_case)
        zipped = F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("m"),
                              F.split("text", pattern, -1).alias("p"))
        found.append(F.when(hit & F.col("text").rlike(pattern), F.struct(F.lit(rule.rule_id).alias("rule_id"), zipped.alias("at"))))
    each = slim.select("path", "file", F.explode(F.array_compact(F.array(*found))).alias("r"))
    rows = each.select("path", "file", "r.rule_id", F.posexplode("r.at").alias("k", "at")).where("at.m IS NOT NULL")
    def feeds(part: str) -> Column:
        return F.length(F.col(f"at.{part}")) - F.length(F.replace(F.col(f"at.{part}"), F.lit("\n")))

    in_order = Window.partitionBy("path", "file", "rule_id").orderBy("k")
    before = F.sum(feeds("p")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(
        F.sum(feeds("m")).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.select("path", "rule_id", (before + 1).cast("int").alias("line_no"),
                       F.replace(F.col("at.m"), F.lit("\n"), F.lit(" ")).alias("excerpt"), F.lit(2).alias("pass"))


def one_per_line(issues: DataFrame) -> DataFrame:
    """One issue per path, rule and line; the line pass goes before the multi-line pass."""
    return issues.groupBy("path", "rule_id", "line_no").agg(
        F.min_by("excerpt", F.struct("pass", "excerpt")).alias("excerpt"), F.min("pass").alias("pass"))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def code_lines(source: pd.Series) -> pd.Series:
    """Line numbers of a Python source that belong to a syntax node; NULL when it does not parse."""
    def lines_of(text):
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                tree = ast.parse(text)
        except (SyntaxError, ValueError, TypeError, RecursionError):
            return None
        found = set()
        for node in ast.walk(tree):
            first = getattr(node, "lineno", None)
            if first:
                found.update(range(first, (getattr(node, "end_lineno", None) or first) + 1))
        return sorted(found)

    return source.map(lines_of)


def mark_code(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """Lines of files with ``is_code``: true for everything but the non-code lines of Python files."""
    marked = files.withColumn("_code", F.when(F.col(path).endswith(".py"), code_lines(F.col(text))))
    lines = file_lines(marked, path, text)
    is_code = F.coalesce(F.array_contains("_code", F.col("line_no")), F.lit(True))
    return lines.withColumn("is_code", is_code).drop("_code")


def scan(files: DataFrame, rules: list[Rule], path: str = "path", text: str = "text") -> DataFrame:
    """All issues of the files, both passes, with rule details."""
    lines = mark_code(files, path, text) if any(r.code_only for r in rules) else file_lines(files, path, text)
    issues = scan_lines(lines, rules, path)
    if any(r.multiline for r in rules):
        issues = issues.unionByName(scan_multiline(files, rules, path, text))
    return with_rule(one_per_line(issues), rules)


def with_rule(issues: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add severity, its rank, category, title and suggestion of each issue's rule."""
    rows = [(r["rule_id"], r["severity"], SEVERITIES.index(r["severity"]), r["category"], r["title"], r["suggestion"])
            for r in map(asdict, rules)]
    details = issues.sparkSession.createDataFrame(
        rows, "rule_id string, severity string, severity_rank int, category string, title string, suggestion string")
    return issues.join(F.broadcast(details), "rule_id")  # the rules are a list of the caller


def summarise(issues: DataFrame) -> DataFrame:
    """Issue counts by severity, category, file and rule in one pass: (grouping, label, issues)."""
    groupings = ("severity", "category", "path", "rule_id")
    label = None
    for name in groupings:
        out = F.when(F.grouping(name) == 0, F.struct(F.lit(name).alias("grouping"), F.col(name).alias("label")))
        label = out if label is None else F.coalesce(label, out)
    counted = issues.groupingSets([[F.col(g)] for g in groupings], *groupings).agg(
        F.count(F.lit(1)).alias("issues"), label.alias("_l"))
    return counted.select("_l.grouping", "_l.label", "issues")


def scan_totals(lines: DataFrame, issues: DataFrame, path: str = "path") -> DataFrame:
    """Files and lines scanned, issues, and files with issues."""
    scanned = lines.groupBy(path).agg(F.count(F.lit(1)).alias("_lines")).agg(
        F.count(F.lit(1)).alias("files_scanned"), F.sum("_lines").alias("lines_scanned"))
    found = issues.groupBy("path").agg(F.count(F.lit(1)).alias("_n")).agg(
        F.count(F.lit(1)).alias("files_with_issues"), F.coalesce(F.sum("_n"), F.lit(0)).alias("issues"))
    both = scanned.unionByName(found, allowMissingColumns=True)  # one row each
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


# ------------------------------------------------------------------ fixes


@dataclass(frozen=True)
class Fix:
    """A replacement of matching line text.

    ``whole_line`` replaces a line that starts with the pattern by the replacement, else every match of
    the target is replaced. ``$1`` names a group. Only the first rule of a ``family`` applies to a line. A fix
    that is not ``fixable`` is only reported.
    """

    rule_id: str
    pattern: str
    replacement: str
    family: str = ""
    category: str = "general"
    severity: str = "DEPRECATED"
    whole_line: bool = False
    fixable: bool = True
    needs: str = ""  # text every match contains; lets other lines skip the pattern
    target: str = ""  # what is replaced, if not the pattern itself


def suggest_fixes(lines: DataFrame, fixes: list[Fix], path: str = "path", comment: str = "#") -> DataFrame:
    """Suggested replacements: (path, line_no, rule_id, rule_order, old_code, new_code, fixable).

    Blank lines and comment lines are left alone, and so is a line the rule would not change.
    """
    stripped = strip("line")
    by_family: dict[str, list[tuple[int, Fix]]] = {}
    for order, fix in enumerate(fixes):
        by_family.setdefault(fix.family or f"#{order}", []).append((order, fix))
    options = []
    for members in by_family.values():
        choice = None
        for order, fix in members:
            pattern = f"^(?:{fix.pattern})" if fix.whole_line else fix.pattern
            target = f"{pattern}.*$" if fix.whole_line else (fix.target or pattern)
            new = F.regexp_replace(stripped, target, fix.replacement)
            row = F.struct(
                F.lit(fix.rule_id).alias("rule_id"), F.lit(order).alias("rule_order"), new.alias("new_code"),
                F.lit(fix.fixable).alias("fixable"))
            test = _holds(stripped, fix.needs) & stripped.rlike(pattern)
            choice = F.when(test, row) if choice is None else choice.when(test, row)
        options.append(choice)
    hits = F.array_compact(F.array(*options))
    some = F.coalesce(*options).isNotNull()
    found = lines.where((stripped != "") & ~stripped.startswith(comment) & some).select(
        F.col(path).alias("path"), "line_no", stripped.alias("old_code"), F.explode_outer(hits).alias("_h"))
    return found.select("path", "line_no", "_h.rule_id", "_h.rule_order", "old_code", "_h.new_code",
                        "_h.fixable").where(F.col("new_code") != F.col("old_code"))


def moved_imports(lines: DataFrame, moves: DataFrame, path: str = "path") -> DataFrame:
    """Imported names that moved: (path, line_no, module, name, new_module, new_name), one row per name.

    ``moves`` has module, name, new_module, new_name; the name ``*`` stands for every name of a module, and a NULL target
    for one that is gone. A line is read as ``from module import name [as other], ...``, with or without parentheses.
    """
    parsed = F.regexp_extract(strip("line"), r"^from\s+([\w.]+)\s+import\s+\(?([^()#]*)", 1)
    listed = F.regexp_extract(strip("line"), r"^from\s+([\w.]+)\s+import\s+\(?([^()#]*)", 2)
    named = lines.where(F.col("line").contains("import")).select(
        F.col(path).alias("path"), "line_no", parsed.alias("module"), F.explode(F.split(listed, ",")).alias("name"))
    named = named.withColumn("name", F.regexp_extract("name", r"^\s*([\w*]+)", 1)).where((F.col("module") != "") & (F.col("name") != ""))
    single = moves.where("name <> '*'").select("module", "name", "new_module", "new_name")
    whole = moves.where("name = '*'").select("module", "new_module")
    return named.join(single, ["module", "name"]).unionByName(
        named.join(whole, "module").withColumn("new_name", F.col("name"))).select(
        "path", "line_no", "module", "name", "new_module", "new_name")


def first_fix_per_line(suggestions: DataFrame) -> DataFrame:
    """The first applicable fix of each line by rule order."""
    return suggestions.where("fixable").groupBy("path", "line_no").agg(
        F.min_by(F.struct("rule_id", "old_code", "new_code"), "rule_order").alias("_f")
    ).select("path", "line_no", "_f.rule_id", "_f.old_code", "_f.new_code")


def apply_fixes(lines: DataFrame, fixes: DataFrame, path: str = "path") -> DataFrame:
    """Lines with fixes put in where the trimmed line still is the old code; indentation stays."""
    joined = lines.join(
        fixes.select(F.col("path").alias(path), "line_no", "old_code", "new_code"), [path, "line_no"], "left")
    same = F.coalesce(strip("line") == F.col("old_code"), F.lit(False))
    indent = F.regexp_extract("line", INDENT, 0)
    fixed = F.when(same, F.concat(indent, F.col("new_code"))).otherwise(F.col("line"))
    return joined.withColumns({"applied": same, "line": fixed}).drop("old_code", "new_code")


def fixed_files(files: DataFrame, fixes: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """File texts after the fixes, with how many were applied.

    A file's fixes are gathered, not its lines: the text is split and rebuilt inside its own row, and
    files without a fix are not touched.
    """
    todo = fixes.groupBy(F.col("path").alias(path)).agg(
        F.map_from_entries(F.collect_list(F.struct("line_no", F.struct("old_code", "new_code")))).alias("_todo"))

    def rebuilt(line: Column, i: Column) -> Column:
        fix = F.try_element_at("_todo", (i + 1).cast("int"))
        hit = F.coalesce(fix["old_code"] == strip(line), F.lit(False))
        body = F.when(hit, F.concat(F.regexp_extract(line, INDENT, 0), fix["new_code"])).otherwise(line)
        return F.struct(body.alias("line"), hit.alias("hit"))

    pieces = files.join(todo, path).select(path, "_todo", split_lines(text).alias("_lines"))
    done = pieces.select(path, F.transform("_lines", rebuilt).alias("_lines"))
    body = F.array_join(F.transform("_lines", lambda x: x["line"]), "\n")
    ended = F.when(body.endswith("\n"), body).otherwise(F.concat(body, F.lit("\n")))
    return done.select(path, ended.alias(text), F.size(F.filter("_lines", lambda x: x["hit"])).alias("applied"))
