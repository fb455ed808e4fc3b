"""Reports, formats, run rows and policy results over the sample tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import partitions, policy, state, textscan
from ..session import scratch_path
from ..sources import checkpoints, datasets, files, reports
from .base import month_spec, read, text
from .governing import FACTS, MAPPED, STATUSES, mapped_pairs, stored_facts, sync_statuses
from .scanning import LINE_RULES, LINES, issues

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn
    return add


# ------------------------------------------------------------------ sources and sinks


FORMATS = ("parquet", "orc", "json", "csv", "TEXTFILE")


@query(" UNION ALL ".join(
    f"SELECT '{f.lower()}' AS format, count(*)::BIGINT AS rows, sum(o_orderkey)::BIGINT AS key_sum, count(DISTINCT o_orderstatus)::BIGINT AS statuses FROM orders"
    for f in FORMATS))
def read_any_format(spark, d):
    """orders written in every format and read by the one reader."""
    path, orders = scratch_path(spark, "formats"), read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    found = None
    for fmt in FORMATS:
        kind = "csv" if fmt == "TEXTFILE" else fmt
        options = {"header": True} if kind == "csv" else {}
        orders.write.format(kind).options(**options).save(f"{path}/{fmt}")
        one = datasets.read_dataset(spark, fmt, f"{path}/{fmt}", **options).agg(
            F.count("*").alias("rows"), F.sum(F.col("o_orderkey").cast("bigint")).alias("key_sum"),
            F.count_distinct("o_orderstatus").alias("statuses")).select(F.lit(fmt.lower()).alias("format"), "*")
        found = one if found is None else found.unionByName(one)
    return found


@query("SELECT DISTINCT 'seg_'||lower(c_mktsegment) AS tbl FROM customer WHERE c_mktsegment <> 'MACHINERY'")
def tables_with_metadata(spark, d):
    """A folder per market segment, all but one with a metadata folder."""
    path = scratch_path(spark, "metadata")
    rows = read(spark, d, "customer").select(F.concat(F.lit("seg_"), F.lower("c_mktsegment")).alias("tbl"), "c_mktsegment", text("c_name").alias("value"))
    for (segment, folder) in rows.select("c_mktsegment", "tbl").distinct().collect():
        mine = rows.where(F.col("c_mktsegment") == segment).select("value")
        mine.coalesce(1).write.text(f"{path}/{folder}/data")
        if segment != "MACHINERY":
            mine.limit(1).write.text(f"{path}/{folder}/metadata")
    return files.tables_with_metadata(files.file_inventory(spark, path)).select("tbl")


@query("""
SELECT 'db'||(s_suppkey % 3) AS database, s_name AS "table", 'p='||s_suppkey AS partition, 's3a://b/x, "'||s_suppkey||'"' AS location, s_suppkey % 2 = 0 AS exists,
  CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey::BIGINT END AS file_count, CASE WHEN s_suppkey % 4 <> 0 THEN (10 * s_suppkey)::BIGINT END AS size_bytes, NULL::BIGINT AS row_count FROM supplier""")
def outside_report(spark, d):
    """The report on partitions outside of their tables, written as CSV and read back; uncounted cells stay empty."""
    k = F.col("s_suppkey")
    counted = F.when(k % 4 != 0, k)
    rows = read(spark, d, "supplier").select(
        F.concat(F.lit("db"), text(k % 3)).alias("database"), F.col("s_name").alias("table"), F.concat(F.lit("p="), text(k)).alias("partition"),
        F.concat(F.lit('s3a://b/x, "'), text(k), F.lit('"')).alias("location"), (k % 2 == 0).alias("exists"), counted.alias("file_count"),
        (counted * 10).alias("size_bytes"), F.lit(None).cast("bigint").alias("row_count"), F.lit("left out").alias("note"))
    path = scratch_path(spark, "outside")
    reports.write_outside_report(rows, path)
    kinds = "database string, table string, partition string, location string, exists boolean, file_count bigint, size_bytes bigint, row_count bigint"
    return spark.read.schema(kinds).option("header", True).option("escape", '"').csv(path)


@query(f"""{LINES},
s AS (SELECT severity, count(*)::BIGINT AS issues, count(DISTINCT path)::BIGINT AS paths FROM i GROUP BY 1)
SELECT 'issues' AS part, severity, issues, paths FROM s UNION ALL SELECT 'summary', severity, issues, NULL FROM s""")
def issue_report(spark, d):
    """The issue report written as JSON, issues by severity and a summary, and read back."""
    found = textscan.with_rule(issues(spark, d), LINE_RULES)
    path = scratch_path(spark, "issues")
    reports.write_issue_report(found, textscan.summarise(found), path)
    one = spark.read.json(f"{path}/issues").groupBy("severity").agg(F.count("*").alias("issues"), F.count_distinct("path").alias("paths"))
    two = spark.read.json(f"{path}/summary").where("grouping = 'severity'").select(
        F.lit("summary").alias("part"), F.col("label").alias("severity"), "issues", F.lit(None).cast("bigint").alias("paths"))
    return one.select(F.lit("issues").alias("part"), "severity", "issues", "paths").unionByName(two)


@query("""
SELECT lang, count(DISTINCT source)::BIGINT AS files, (sum(length(text)) + count(*))::BIGINT AS chars FROM documents WHERE text <> '' AND lang <> 'de' GROUP BY 1""")
def source_tree(spark, d):
    """documents as source files in a tree, one a source and language, walked without the skipped folders."""
    path = scratch_path(spark, "tree")
    docs = read(spark, d, "documents").where("text <> ''")
    folder = F.when(F.col("lang") == "de", F.lit("build")).otherwise(F.lit("src"))
    docs.select(folder.alias("folder"), "lang", "source", "text").repartition("lang", "source").write.partitionBy(
        "folder", "lang", "source").text(path)
    found = files.read_sources(spark, path)
    kept = found.where(textscan.scannable(F.regexp_replace(F.col("path"), "folder=", ""), endings=(".txt",)))
    return kept.groupBy(F.regexp_extract("path", "lang=([^/]*)/", 1).alias("lang")).agg(
        F.count("*").alias("files"), F.sum(F.length("text")).cast("bigint").alias("chars"))


@query("""
WITH t AS (SELECT DISTINCT c_mktsegment AS source_database, 'n'||c_nationkey AS source_table FROM customer)
SELECT *, row_number() OVER (ORDER BY source_database, source_table)::BIGINT AS place FROM t""")
def report_order(spark, d):
    """The rows of a report as they come, numbered: by database and table."""
    rows = read(spark, d, "customer").select(F.col("c_mktsegment").alias("source_database"), F.concat(F.lit("n"), text("c_nationkey")).alias(
        "source_table")).distinct()
    came = reports.ordered_by_table(rows).withColumn("at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.orderBy("at")).cast("bigint")  # one row per table of the report
    return came.select("source_database", "source_table", place.alias("place"))


@query("""
WITH s AS (SELECT DISTINCT l_orderkey % 50 AS id, strftime(l_shipdate, '%Y') AS y, strftime(l_shipdate, '%m') AS m FROM lineitem)
SELECT id::BIGINT AS id, y||'/'||m AS spec, unnest(['year', 'month', 'note']) AS k, unnest([y, m, 'a b/c']) AS v FROM s""")
def spec_maps(spark, d):
    """Partition specs with an escaped value as maps, an entry a row."""
    rows = read(spark, d, "lineitem").select((F.col("l_orderkey") % 50).alias("id"), F.date_format("l_shipdate", "yyyy/MM").alias("short"), F.concat(
        month_spec("l_shipdate"), F.lit("/note=a%20b%2Fc")).alias("spec")).distinct()
    return rows.select("id", "short", F.explode(partitions.spec_map("spec")).alias("k", "v")).withColumnRenamed("short", "spec")


@query("""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS text, greatest(ceil(length(coalesce(text, '')) / 1000.0), 1)::INT AS n FROM documents)
SELECT doc_id, lang, i::BIGINT AS piece, n::BIGINT AS pieces, CASE WHEN text <> '' THEN substr(text, 1000 * i + 1, 1000) END AS text FROM (SELECT *, unnest(range(n)) AS i FROM t)""")
def diagnostic_pieces(spark, d):
    """Records with whole texts as JSON pieces of bounded length, parsed back."""
    docs = read(spark, d, "documents").select("doc_id", "lang", F.when(F.col("text") != "", F.col("text")).alias("text"))
    pieces = docs.select(F.explode(keys.json_pieces(F.struct("doc_id", "lang", "text"), "text", 1000)).alias("json"))
    kinds = "doc_id bigint, lang string, text string, piece bigint, pieces bigint"
    return pieces.select(F.from_json("json", kinds).alias("r")).select("r.doc_id", "r.lang", "r.piece", "r.pieces", "r.text")


# ------------------------------------------------------------------ runs


RUNS = [f"run_20240101_00000{i}_0000000{i}" for i in range(3)]


@query(f"""
WITH s AS (SELECT user_id % 3 AS r, count(*) AS n FROM events GROUP BY 1)
SELECT 'run_20240101_00000'||r||'_0000000'||r AS run_id, CASE r WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'COMPLETED_WITH_FAILURES' ELSE 'RUNNING' END AS status, '2024-01-01 00:00:0'||r AS started_at,
  CASE WHEN r < 2 THEN '2024-01-01 01:00:00' END AS completed_at, CASE WHEN r = 1 THEN 0 ELSE n END::BIGINT AS checkpoints FROM s""")
def run_rows(spark, d):
    """Three runs opened, two of them closed, and the checkpoints of one dropped."""
    path, run = scratch_path(spark, "runs"), F.concat(F.lit("run_20240101_00000"), text(F.col("user_id") % 3), F.lit("_0000000"), text(F.col("user_id") % 3))
    records = read(spark, d, "events").select(run.alias("run_id"), text("user_id").alias("checkpoint_key"), F.lit("done").alias("status"))
    checkpoints.write_checkpoints(records, path)
    checkpoints.drop_run(spark, path, RUNS[1])
    log = None
    for i, name in enumerate(RUNS):
        opened = state.open_run(spark, name, f"2024-01-01 00:00:0{i}")
        log = opened if log is None else log.unionByName(opened)
    outcome = spark.createDataFrame([(RUNS[0], "COMPLETED"), (RUNS[1], "COMPLETED_WITH_FAILURES")], "run_id string, run_status string")
    runs = state.run_view(log.unionByName(state.close_run(outcome, "2024-01-01 01:00:00")))
    left = checkpoints.read_checkpoints(spark, path).groupBy("run_id").agg(F.count("*").alias("checkpoints"))
    return runs.join(left, "run_id", "left").withColumn("checkpoints", F.coalesce("checkpoints", F.lit(0)))


# ------------------------------------------------------------------ policies


@query(f"""{MAPPED},
rs AS (SELECT DISTINCT policy, CASE WHEN policy LIKE '%t1%' THEN 'FAILED' ELSE 'CREATED' END AS status, CASE WHEN policy LIKE '%t1%' THEN 'refused' ELSE '' END AS err FROM gr WHERE policy NOT LIKE '%db1%'),
cl AS (SELECT policy, 'different row filters: '||min(value)||' and '||max(value) AS clash FROM facts WHERE kind = 'rowfilter' GROUP BY 1 HAVING count(DISTINCT value) > 1),
st AS (SELECT policy, bool_or(state = 'applied') AS applied FROM gr GROUP BY 1),
en AS (SELECT policy, kind AS fact, value FROM facts WHERE kind IN ('user', 'permission', 'rowfilter') UNION SELECT policy, 'group', role FROM gr JOIN st USING (policy) WHERE state = 'applied' OR NOT applied
  UNION SELECT policy, 'excluded', role FROM gr WHERE state = 'excluded')
SELECT en.policy, CASE WHEN rs.policy IS NULL THEN en.policy ELSE 'id_'||length(en.policy) END AS policy_id, CASE WHEN clash IS NOT NULL THEN 'FAILED' ELSE coalesce(rs.status, 'RUNNING') END AS status,
  concat_ws(' | ', nullif(rs.err, ''), clash) AS error_message, fact, value FROM en LEFT JOIN rs USING (policy) LEFT JOIN cl ON cl.policy = en.policy""")
def final_status_facts(spark, d):
    """Users, permissions, groups, row filters and left-out roles of every policy with its final status, an entry a row."""
    found = stored_facts(spark, d)
    _, grants, _ = policy.keep_mapped(found, mapped_pairs(found))
    bad = F.col("policy").contains("t1")
    base = grants.where(~F.col("policy").contains("db1")).select("policy").distinct().select(
        "policy", F.concat(F.lit("id_"), text(F.length("policy"))).alias("policy_id"),
        F.when(bad, "FAILED").otherwise("CREATED").alias("status"), F.when(bad, "refused").otherwise("").alias("error_message"))
    companions = base.select(F.concat("policy", F.lit("__rowfilter")).alias("policy"), F.lit("id_x").alias("policy_id"),
                             F.lit("UPDATED").alias("status"), F.lit("").alias("error_message"))
    return policy.final_status_facts(found, grants, base.unionByName(companions))


@query(f"""{FACTS},
rf AS (SELECT policy, role AS grp, min(value) AS rowfilter FROM facts WHERE kind = 'rowfilter' GROUP BY 1, 2),
lb AS (SELECT DISTINCT policy, 'label_'||role AS label FROM facts),
cur AS (SELECT policy, grp, rowfilter||' or old' AS rowfilter FROM rf UNION ALL SELECT DISTINCT policy, 'old_group', 'x = 1' FROM facts WHERE kind = 'permission'),
des AS (SELECT * FROM rf WHERE grp <> 'role_14'), upd AS (SELECT DISTINCT policy FROM facts WHERE kind = 'permission' AND value = 'all'),
old AS (SELECT * FROM cur WHERE policy NOT IN (SELECT policy FROM upd) OR policy IN (SELECT policy FROM des))
SELECT 'rowfilter' AS what, policy, grp, coalesce(d.rowfilter, o.rowfilter) AS value FROM old o FULL JOIN des d USING (policy, grp)
UNION ALL SELECT 'label', policy, NULL, label FROM lb UNION ALL SELECT DISTINCT 'label', policy, NULL, 'kept' FROM facts WHERE kind = 'user'""")
def merge_existing(spark, d):
    """Row filters and labels merged into those of existing policies; updated policies without row filters lose theirs."""
    found = stored_facts(spark, d)
    filters = found.where("kind = 'rowfilter'").groupBy("policy", F.col("role").alias("grp")).agg(F.min("value").alias("rowfilter"))
    given = found.where("kind = 'permission'")
    current = filters.withColumn("rowfilter", F.concat("rowfilter", F.lit(" or old"))).unionByName(
        given.select("policy", F.lit("old_group").alias("grp"), F.lit("x = 1").alias("rowfilter")).distinct())
    merged = policy.merge_rowfilters(current, filters.where("grp <> 'role_14'"), given.where("value = 'all'"))
    labels = policy.merge_labels(found.where("kind = 'user'").select("policy", F.lit("kept").alias("label")),
                                 found.select("policy", F.concat(F.lit("label_"), "role").alias("label")))
    return merged.select(F.lit("rowfilter").alias("what"), "policy", "grp", F.col("rowfilter").alias("value")).unionByName(
        labels.select(F.lit("label").alias("what"), "policy", F.lit(None).cast("string").alias("grp"), F.col("label").alias("value")))


@query(f"""{STATUSES},
pol AS (SELECT DISTINCT policy, item_type FROM facts), act AS (SELECT policy, CASE WHEN policy LIKE '%t1%' THEN 'FAILED' WHEN bool_or(item_type = 'deny') THEN 'RUNNING' WHEN bool_or(item_type = 'allow') AND policy LIKE '%db1%' THEN 'UPDATED' ELSE 'CREATED' END AS status FROM pol GROUP BY 1),
grp AS (SELECT role, CASE WHEN role LIKE '%1' THEN 'ALREADY_EXISTS' ELSE 'CREATED' END AS status FROM (SELECT DISTINCT role FROM facts)),
every AS (SELECT object_type, status FROM ss UNION ALL SELECT 'policy', CASE WHEN status = 'RUNNING' THEN 'FAILED' ELSE status END FROM act UNION ALL SELECT 'ranger_group', status FROM grp)
SELECT {", ".join(f"count(*) FILTER (object_type = '{t}' AND status = '{s}')::BIGINT AS {a}" for a, t, s in (
    ("groups_created", "ranger_group", "CREATED"), ("groups_existing", "ranger_group", "ALREADY_EXISTS"), ("policies_created", "policy", "CREATED"),
    ("policies_updated", "policy", "UPDATED"), ("policies_failed", "policy", "FAILED"), ("roles_created", "role", "CREATED"), ("roles_existing", "role", "ALREADY_EXISTS"),
    ("mappings_created", "mapping", "CREATED"), ("mappings_existing", "mapping", "ALREADY_EXISTS")))},
  count(*)::BIGINT AS total_objects, count(*) FILTER (status <> 'FAILED')::BIGINT AS successful_objects, count(*) FILTER (status = 'FAILED')::BIGINT AS failed_objects,
  CASE WHEN count(*) FILTER (status = 'FAILED') > 0 THEN 'PARTIAL_FAILURE' ELSE 'COMPLETED' END AS overall_status FROM every""")
def full_run_metrics(spark, d):
    """Metrics of a run with groups, policies, roles and mappings in every state."""
    found = stored_facts(spark, d)
    p = F.col("policy")
    kinds = found.groupBy("policy").agg(F.max(F.col("item_type") == "deny").alias("deny"), F.max(F.col("item_type") == "allow").alias("allow"))
    acted = kinds.select(F.lit("policy").alias("object_type"), p.alias("object_name"), F.when(p.contains("t1"), "FAILED").when(
        F.col("deny"), "RUNNING").when(F.col("allow") & p.contains("db1"), "UPDATED").otherwise("CREATED").alias("status"))
    groups = found.select("role").distinct().select(F.lit("ranger_group").alias("object_type"), F.col("role").alias("object_name"), F.when(
        F.col("role").endswith("1"), "ALREADY_EXISTS").otherwise("CREATED").alias("status"))
    return policy.run_metrics(sync_statuses(spark, d).unionByName(acted).unionByName(groups))
