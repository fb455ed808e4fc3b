"""Rule scans over the sample texts: lines of documents, whole documents, generated sources, web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import textscan
from ..operators.textscan import Fix, Rule
from ..session import materialize
from .base import read, text

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn
    return add


TEXT = (".txt",)
LINE_RULES = [
    Rule("MAIL-1", r"[a-z0-9]+\.[0-9]+@[a-z0-9]+\.[a-z]+", "high", "personal", "mail address", "remove it", TEXT,
         needs="@"),
    Rule("TEL-1", r"\([0-9]{3}\) [0-9]{3}-[0-9]{4}", "high", "personal", "telephone number", "remove it", TEXT,
         needs=") "),
    Rule("LIC-1", r"license", "low", "legal", "license line", "keep it", TEXT, ignore_case=True,
         needs="license"),
    Rule("NUM-1", r"[0-9]{12,}", "critical", "secret", "key-like number", "replace it", TEXT),
    Rule("NOISE-1", r"[%#$*]{3}", "info", "quality", "noise", "clean it", TEXT),
    Rule("HEAD-1", r"^The\b", "medium", "style", "line head", "none", TEXT, needs="The"),
]
MULTI_RULES = [
    Rule("BREAK-1", r"[a-z]+\.\n[A-Z][a-z]*", "medium", "style", "sentence over a break", "join", TEXT, multiline=True),
    Rule("SPAN-1", r"%%%.{1,60}?###", "info", "quality", "noise span", "clean it", TEXT, multiline=True),
]
DOC_PATH = "source||'/'||lang||'/'||doc_id||'.txt'"


def _rules_sql(rules: list[Rule]) -> str:
    def row(r: Rule) -> str:
        lead = "(?i)" if r.ignore_case else ""
        return f"('{r.rule_id}', '{lead}{r.pattern}', '{r.severity}', '{r.category}')"

    return "(VALUES " + ", ".join(row(r) for r in rules) + ") r(rule_id, pattern, severity, category)"


LINES = f"""
WITH d AS (SELECT {DOC_PATH} AS path, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS ls FROM documents WHERE text <> ''),
l AS (SELECT path, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM d),
i AS (SELECT path, rule_id, severity, category, line_no, trim(line, ' ' || chr(9)) AS excerpt FROM l JOIN {_rules_sql(LINE_RULES)} ON regexp_matches(line, pattern))"""


def document_files(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select(
        F.concat_ws("/", "source", "lang", F.concat(text("doc_id"), F.lit(".txt"))).alias("path"), "text")


def issues(spark: SparkSession, d: str) -> DataFrame:
    return textscan.scan_lines(textscan.file_lines(document_files(spark, d)), LINE_RULES)


@query(f"{LINES} SELECT path, rule_id, line_no::BIGINT AS line_no, excerpt FROM i")
def scan_lines(spark, d):
    return issues(spark, d).select("path", "rule_id", F.col("line_no").cast("bigint").alias("line_no"), "excerpt")


@query(f"{LINES} SELECT path, rule_id, line_no::BIGINT AS line_no, severity FROM i WHERE severity IN ('critical', 'high') AND category = 'personal'")
def scan_severe(spark, d):
    rules = textscan.pick_rules(LINE_RULES, "high", ["personal"])
    found = textscan.scan(document_files(spark, d), rules)
    return found.select("path", "rule_id", F.col("line_no").cast("bigint").alias("line_no"), "severity")


@query(f"""{LINES}
SELECT CASE WHEN grouping(severity) = 0 THEN 'severity' WHEN grouping(category) = 0 THEN 'category' WHEN grouping(path) = 0 THEN 'path' ELSE 'rule_id' END AS "grouping",
  coalesce(severity, category, path, rule_id) AS label, count(*)::BIGINT AS issues FROM i GROUP BY GROUPING SETS ((severity), (category), (path), (rule_id))""")
def scan_summary(spark, d):
    return textscan.summarise(textscan.with_rule(issues(spark, d), LINE_RULES))


@query(f"""{LINES}
SELECT (SELECT count(DISTINCT path) FROM l)::BIGINT AS files_scanned, (SELECT count(*) FROM l)::BIGINT AS lines_scanned,
  (SELECT count(DISTINCT path) FROM i)::BIGINT AS files_with_issues, (SELECT count(*) FROM i)::BIGINT AS issues""")
def scan_totals(spark, d):
    return textscan.line_totals(textscan.file_lines(document_files(spark, d)), LINE_RULES)


# A large rule set: beginnings of words, put together from two lists.
HEADS = ("tho", "tht", "tha", "thi", "thn", "ere", "tio", "que", "ene", "men", "sch", "ble", "ing", "one", "ein", "oft", "die", "ent", "ers", "ono")
TAILS = ("the", "thre", "erin", "tion", "than", "ther", "ent", "ing", "nden", "que")
MANY_RULES = [Rule(f"W-{a}-{b}", rf"(^| ){a}{b}[a-z]*", "info", "words", f"{a}{b}", "none", TEXT) for a in HEADS for b in TAILS]


@query(f"""{LINES.replace(_rules_sql(LINE_RULES), _rules_sql(LINE_RULES + MANY_RULES))}
SELECT path, rule_id, line_no::BIGINT AS line_no, excerpt FROM i""")
def scan_many_rules(spark, d):
    """Two hundred and six rules over all lines, those that a line cannot match never tried."""
    found = textscan.scan_by_literals(textscan.file_lines(document_files(spark, d)), LINE_RULES + MANY_RULES)
    return found.select("path", "rule_id", F.col("line_no").cast("bigint").alias("line_no"), "excerpt")


def _multi_sql(rule: Rule) -> str:
    return f"""SELECT '{rule.rule_id}' AS rule_id, path, regexp_extract_all(text, '{rule.pattern}', 0, 's') AS ms,
  string_split_regex(text, '(?s){rule.pattern}') AS ps FROM f WHERE regexp_matches(text, '{rule.pattern}', 's')"""


@query(f"""
WITH f AS (SELECT {DOC_PATH} AS path, text FROM documents UNION ALL SELECT {DOC_PATH}, text FROM documents WHERE lang = 'de'),
m AS ({' UNION ALL '.join(_multi_sql(r) for r in MULTI_RULES)}),
x AS (SELECT rule_id, path, unnest(ms) AS hit, generate_subscripts(ms, 1) AS k, ms, ps FROM m),
y AS (SELECT rule_id, path, hit, k, 1 + list_sum(list_transform(ps[1:k], lambda s: length(s) - length(replace(s, chr(10), ''))))
  + coalesce(list_sum(list_transform(ms[1:k - 1], lambda s: length(s) - length(replace(s, chr(10), '')))), 0) AS line_no FROM x)
SELECT path, rule_id, line_no::BIGINT AS line_no, min(replace(hit, chr(10), ' ')) AS excerpt FROM y GROUP BY 1, 2, 3""")
def scan_multiline(spark, d):
    """Rules over whole documents; those of one language come twice, as equal rows."""
    files = document_files(spark, d)
    files = files.unionByName(files.where(F.split("path", "/")[1] == "de"))
    found = textscan.one_per_line(textscan.scan_multiline(files, MULTI_RULES))
    return found.select("path", "rule_id", F.col("line_no").cast("bigint").alias("line_no"), "excerpt")


# A Python source per part: a docstring, an assignment, a comment and, for one size, a syntax error.
CODE_RULES = [
    Rule("RED-1", r"\bred\b", "high", "colour", "red in code", "paint", (".py",), code_only=True),
    Rule("RED-2", r"\bred\b", "low", "colour", "red anywhere", "paint", (".py",)),
]


@query("""
WITH f AS (SELECT 'src/p'||p_partkey||'.py' AS path, p_size, ['"""+'"""'+"""'||p_name, p_type||' red', '"""+'"""'+"""', 'x = "'||p_name||'"  # red', '# red '||p_name, '', 'y = '||p_size||CASE WHEN p_size = 13 THEN ' (' ELSE '' END] AS ls FROM part),
l AS (SELECT path, p_size, unnest(ls) AS line, generate_subscripts(ls, 1) AS n FROM f)
SELECT path, 'RED-2' AS rule_id, n::BIGINT AS line_no FROM l WHERE regexp_matches(line, '\\bred\\b')
UNION ALL SELECT path, 'RED-1', n FROM l WHERE regexp_matches(line, '\\bred\\b') AND (p_size = 13 OR n <> 5)""")
def scan_code_lines(spark, d):
    quotes = F.lit('"""')
    body = F.array_join(F.array(
        F.concat(quotes, "p_name"), F.concat("p_type", F.lit(" red")), quotes,
        F.concat(F.lit('x = "'), "p_name", F.lit('"  # red')), F.concat(F.lit("# red "), "p_name"), F.lit(""),
        F.concat(F.lit("y = "), text("p_size"), F.when(F.col("p_size") == 13, F.lit(" (")).otherwise(F.lit("")))), "\n")
    sources = read(spark, d, "part").select(
        F.concat(F.lit("src/p"), text("p_partkey"), F.lit(".py")).alias("path"), body.alias("text"))
    lines = textscan.mark_code(sources)
    return textscan.scan_lines(lines, CODE_RULES).select("path", "rule_id", F.col("line_no").cast("bigint").alias("line_no"))


@query(f"""
SELECT {DOC_PATH} AS path FROM documents WHERE lang <> 'de' AND source <> 'src7'""")
def pick_files(spark, d):
    """Files by name ending, without skipped folders: German files go to a build folder, one source to *.pyc."""
    docs = read(spark, d, "documents")
    plain = F.concat_ws("/", "source", "lang", F.concat(text("doc_id"), F.lit(".txt")))
    name = (F.when(F.col("lang") == "de", F.concat(F.lit("a/build/"), plain))
            .when(F.col("source") == "src7", F.concat(plain, F.lit(".pyc"))).otherwise(plain))
    return docs.select(name.alias("path")).where(textscan.scannable("path", endings=(".txt", ".pyc")))


# ------------------------------------------------------------------ moved imports

# A source line per part: an import of several names, some moved, some renamed in the import, one module moved whole.
MOVES = [("paint.base", "Red", "colour", "Crimson"), ("paint.base", "Blue", "colour", "Blue"), ("paint.old", "*", "paint.new", "*"),
         ("paint.gone", "Wash", None, None)]
NAMES = "['paint.base', 'paint.old', 'paint.gone', 'other']"


@query(f"""
WITH f AS (SELECT 'src/p'||p_partkey||'.py' AS path, {NAMES}[1 + p_partkey % 4] AS module,
  [['Red', 'Blue as B', 'Green'], ['Wash', 'Red as R']][1 + (p_size % 2)::INT] AS names FROM part),
n AS (SELECT path, module, unnest(list_transform(names, lambda x: split_part(x, ' ', 1))) AS name FROM f),
m(module, name, new_module, new_name) AS (VALUES ('paint.base', 'Red', 'colour', 'Crimson'), ('paint.base', 'Blue', 'colour', 'Blue'),
  ('paint.old', '*', 'paint.new', '*'), ('paint.gone', 'Wash', NULL, NULL))
SELECT n.path, 2::BIGINT AS line_no, n.module, n.name, m.new_module, CASE WHEN m.new_name = '*' THEN n.name ELSE m.new_name END AS new_name
FROM n JOIN m ON m.module = n.module AND m.name IN (n.name, '*')""")
def moved_imports(spark, d):
    modules = F.array(*[F.lit(x) for x in ("paint.base", "paint.old", "paint.gone", "other")])
    names = F.when(F.col("p_size") % 2 == 0, F.lit("Red, Blue as B, Green")).otherwise(F.lit("(Wash,  Red as R)"))
    line = F.concat(F.lit("  from "), F.get(modules, (F.col("p_partkey") % 4).cast("int")), F.lit(" import "), names)
    sources = read(spark, d, "part").select(F.concat(F.lit("src/p"), text("p_partkey"), F.lit(".py")).alias("path"),
                                            F.concat(F.lit("# from paint.base import Red\n"), line).alias("text"))
    moves = spark.createDataFrame(MOVES, "module string, name string, new_module string, new_name string")
    found = textscan.moved_imports(textscan.file_lines(sources), moves)
    return found.withColumn("line_no", F.col("line_no").cast("bigint"))


# ------------------------------------------------------------------ fixes

FIXES = [
    Fix("BOLD-1", r"<b>([A-Z][a-z]*)", r"<strong>$1", family="tag", needs="<b>"),
    Fix("PARA-1", r"<p>", r"<p class=x>", family="tag", needs="<p>"),
    Fix("AMP-1", r"&amp;(&amp;)+", r"&amp;", family="amp", needs="&amp;&amp;"),
    Fix("CLOSE-1", r"</body>", r"END", family="close", whole_line=True, needs="</body>"),
    Fix("NAV-1", r"<nav>", r"MANUAL", family="nav", fixable=False, needs="<nav>"),
]
PAGE_LINES = """
WITH d AS (SELECT page_id||'.html' AS path, string_split(regexp_replace(html, '\\n$', ''), chr(10)) AS ls FROM pages WHERE html <> ''),
l AS (SELECT path, line, trim(line, ' ' || chr(9)) AS s, line_no FROM (SELECT path, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM d)),
h AS (SELECT path, line_no, s AS old_code, 'BOLD-1' AS rule_id, 0 AS ord, regexp_replace(s, '<b>([A-Z][a-z]*)', '<strong>\\1', 'g') AS new_code, true AS fixable FROM l WHERE regexp_matches(s, '<b>[A-Z][a-z]*')
  UNION ALL SELECT path, line_no, s, 'PARA-1', 1, replace(s, '<p>', '<p class=x>'), true FROM l WHERE contains(s, '<p>') AND NOT regexp_matches(s, '<b>[A-Z][a-z]*')
  UNION ALL SELECT path, line_no, s, 'AMP-1', 2, regexp_replace(s, '&amp;(&amp;)+', '&amp;', 'g'), true FROM l WHERE contains(s, '&amp;&amp;')
  UNION ALL SELECT path, line_no, s, 'CLOSE-1', 3, 'END', true FROM l WHERE starts_with(s, '</body>')
  UNION ALL SELECT path, line_no, s, 'NAV-1', 4, replace(s, '<nav>', 'MANUAL'), false FROM l WHERE contains(s, '<nav>')),
g AS (SELECT * FROM h WHERE old_code <> '' AND NOT starts_with(old_code, '#') AND old_code <> new_code),
b AS (SELECT path, line_no, arg_min(old_code, ord) AS old_code, arg_min(new_code, ord) AS new_code FROM g WHERE fixable GROUP BY 1, 2),
r AS (SELECT l.path, l.line_no, b.new_code IS NOT NULL AS hit, CASE WHEN b.new_code IS NULL THEN line ELSE regexp_extract(line, '^\\s*')||b.new_code END AS line FROM l LEFT JOIN b ON b.path = l.path AND b.line_no = l.line_no)"""


def page_files(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select(F.concat(text("page_id"), F.lit(".html")).alias("path"), F.col("html").alias("text"))


def suggestions(spark: SparkSession, d: str) -> DataFrame:
    return textscan.suggest_fixes(textscan.file_lines(page_files(spark, d)), FIXES)


@query(f"{PAGE_LINES} SELECT path, line_no::BIGINT AS line_no, rule_id, fixable, md5(old_code) AS old_code, md5(new_code) AS new_code FROM g")
def suggest_fixes(spark, d):
    return suggestions(spark, d).select(
        "path", F.col("line_no").cast("bigint").alias("line_no"), "rule_id", "fixable", F.md5("old_code").alias("old_code"),
        F.md5("new_code").alias("new_code"))


@query(f"""{PAGE_LINES}
SELECT path, md5(string_agg(line, chr(10) ORDER BY line_no)||chr(10)) AS text, count(*) FILTER (hit)::BIGINT AS applied FROM r WHERE path IN (SELECT path FROM b) GROUP BY 1""")
def apply_fixes(spark, d):
    fixes = textscan.first_fix_per_line(suggestions(spark, d))
    out = textscan.fixed_files(page_files(spark, d), fixes)
    return out.select("path", F.md5("text").alias("text"), F.col("applied").cast("bigint").alias("applied"))


@query(f"{PAGE_LINES} SELECT path, line_no::BIGINT AS line_no, md5(line) AS line, hit AS applied FROM r")
def fixed_lines(spark, d):
    lines = textscan.file_lines(page_files(spark, d))
    fixes = materialize(textscan.first_fix_per_line(textscan.suggest_fixes(lines, FIXES)), "fixes")
    out = textscan.apply_fixes(lines, fixes)
    return out.select("path", F.col("line_no").cast("bigint").alias("line_no"), F.md5("line").alias("line"), "applied")
