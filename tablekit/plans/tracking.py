"""Run and status history over the sample tables: logs, latest states, outcomes, reasons, lifecycle."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import errors, keys, text as words
from ..operators import lifecycle, ordered, partitions, reconcile, state
from ..session import scratch_path
from ..sources import checkpoints, datasets, files, metadata, sheets
from .base import month_spec, read, text

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn
    return add


# ------------------------------------------------------------------ events to states

PHASE_OF = {"view": "discovery", "signup": "copy", "purchase": "create", "click": "validate", "error": "reconcile"}
PHASE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PHASE_OF.items()) + " END"
RANK_SQL = "CASE event_type WHEN 'view' THEN 0 WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'click' THEN 4 ELSE 5 END"
STATUS_SQL = """CASE WHEN value < 3 THEN 'FAILED' WHEN value < 5 THEN 'EMPTY_SOURCE' WHEN value < 6 THEN 'SKIPPED_VIEW'
  WHEN event_type = 'click' THEN 'VALIDATED' WHEN event_type = 'purchase' THEN 'TABLE_CREATED' WHEN value > 70 THEN 'VALIDATION_FAILED' ELSE 'COPIED' END"""
EVENTS = f"""
WITH e AS (SELECT 'run' AS run_id, user_id||'/'||strftime(ts, '%Y-%m-%d') AS tbl, {PHASE_SQL} AS phase, {RANK_SQL} AS rank, {STATUS_SQL} AS status,
  floor(value / 25)::INT AS attempt, value > 40 AS cp, event_id AS seq, CASE WHEN value < 3 THEN 'low '||event_id END AS err FROM events),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tbl, phase ORDER BY attempt DESC, cp DESC, seq DESC) AS rn FROM e) WHERE rn = 1),
q AS (SELECT *, status IN ('FAILED', 'EMPTY_SOURCE', 'SKIPPED_VIEW') AS sticky FROM p),
s AS (SELECT tbl, coalesce(min_by(status, rank) FILTER (sticky), max_by(status, rank)) AS status, coalesce(min_by(phase, rank) FILTER (sticky), max_by(phase, rank)) AS decided_in,
  count(*) AS phases, CASE WHEN count(*) FILTER (sticky) > 0 THEN min_by(coalesce(err, '-'), rank) FILTER (sticky) ELSE max_by(coalesce(err, '-'), rank) END AS err FROM q GROUP BY 1)"""


def status_events(spark: SparkSession, d: str) -> DataFrame:
    """events as status events: a slice per user and day, the event type as its phase."""
    value, kind = F.col("value"), F.col("event_type")
    phase = None
    for event, name in PHASE_OF.items():
        phase = F.when(kind == event, name) if phase is None else phase.when(kind == event, name)
    status = (
        F.when(value < 3, "FAILED").when(value < 5, "EMPTY_SOURCE").when(value < 6, "SKIPPED_VIEW")
        .when(kind == "click", "VALIDATED").when(kind == "purchase", "TABLE_CREATED")
        .when(value > 70, "VALIDATION_FAILED").otherwise("COPIED"))
    return read(spark, d, "events").select(
        F.lit("run").alias("run_id"), F.lit("db").alias("source_database"),
        F.concat(text("user_id"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd")).alias("source_table"),
        F.lit("dw").alias("dest_database"), F.when(value > 30, F.lit("")).alias("partition_filter"),
        phase.alias("phase"), status.alias("status"), F.floor(value / 25).cast("int").alias("attempt"),
        (value > 40).alias("is_checkpoint"), F.col("event_id").alias("seq"),
        F.when(value < 3, F.concat(F.lit("low "), text("event_id"))).alias("error_message"))


@query(f"""{EVENTS} SELECT tbl AS source_table, status, decided_in, phases::BIGINT AS phases, nullif(err, '-') AS error_message FROM s""")
def status_precedence(spark, d):
    return state.overall_status(status_events(spark, d), list(state.SLICE)).select(
        "source_table", "status", "decided_in", "phases", "error_message")


@query(f"""{EVENTS} SELECT tbl AS source_table, status, phases::BIGINT AS phases FROM s""")
def event_log(spark, d):
    """The same states through a written log: two appends with different columns, read back, compacted."""
    events = status_events(spark, d)
    path = scratch_path(spark, "events")
    early = events.where(F.col("phase").isin("discovery", "copy")).drop("error_message")
    state.append_events(early, path)
    state.append_events(events.where(~F.col("phase").isin("discovery", "copy")), path)
    compacted = state.compact(spark, path, list(state.SLICE))
    return state.overall_status(state.read_events(spark, compacted), list(state.SLICE)).select(
        "source_table", "status", "phases")


@query("""
WITH o AS (SELECT user_id, arg_min(event_type, event_id) AS status, 'kept '||user_id AS note, min(value) AS v FROM events GROUP BY 1 HAVING user_id < 120),
n AS (SELECT user_id, arg_max(event_type, event_id) AS status, arg_max(CASE WHEN event_type = 'error' THEN 'new '||event_id ELSE '' END, event_id) AS note, arg_max(value, event_id) AS v FROM events WHERE user_id > 30 GROUP BY 1)
SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce(n.status, o.status) AS status, CASE WHEN n.user_id IS NULL THEN o.note WHEN n.note = '' THEN o.note ELSE n.note END AS note,
  coalesce(n.v, o.v) AS v FROM o FULL JOIN n ON o.user_id = n.user_id""")
def last_result_wins(spark, d):
    events = read(spark, d, "events")
    old = events.where(F.col("user_id") < 120).groupBy("user_id").agg(
        F.min_by("event_type", "event_id").alias("status"),
        F.concat(F.lit("kept "), text(F.first("user_id"))).alias("note"), F.min("value").alias("v"))
    note = F.when(F.col("event_type") == "error", F.concat(F.lit("new "), text("event_id"))).otherwise("")
    new = events.where(F.col("user_id") > 30).select(
        "user_id", F.col("event_type").alias("status"), note.alias("note"), F.col("value").alias("v"), "event_id")
    return state.merge_latest(old, new, ["user_id"], ["note"], [F.col("event_id")])


@query("""
SELECT o_orderkey, 'FAILED' AS status, '[TASK_DID_NOT_PROCESS] no result was reported' AS error_message
FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def unprocessed(spark, d):
    expected = read(spark, d, "orders").select("o_orderkey")
    seen = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return state.unreported(expected, seen, ["o_orderkey"])


@query("""
SELECT p.p_partkey, coalesce(CASE WHEN s.n > 20 THEN 'CONFIRMED' WHEN s.n > 0 THEN 'MISSING' END, 'UNKNOWN') AS presence
FROM part p LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_quantity > 5 AND l_returnflag = 'R' GROUP BY 1) s ON s.l_partkey = p.p_partkey""")
def attach_presence(spark, d):
    seen = read(spark, d, "lineitem").where((F.col("l_quantity") > 5) & (F.col("l_returnflag") == "R"))
    seen = seen.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    found = seen.select("p_partkey", F.when(F.col("n") > 20, "CONFIRMED").otherwise("MISSING").alias("presence"))
    return state.with_presence(read(spark, d, "part").select("p_partkey"), found, ["p_partkey"])


# ------------------------------------------------------------------ outcomes and reports

# Orders stand for tracked items: a run per customer and year, the status from order status and priority.
ITEM_SQL = """SELECT o_custkey||'-'||year(o_orderdate) AS run_id, CASE
  WHEN o_orderstatus = 'F' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'VALIDATED' WHEN '2-HIGH' THEN 'EMPTY_SOURCE' WHEN '3-MEDIUM' THEN 'SKIPPED_VIEW' ELSE 'COMPLETED' END
  WHEN o_orderstatus = 'O' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'FAILED' WHEN '2-HIGH' THEN 'SOURCE_NOT_FOUND' WHEN '3-MEDIUM' THEN 'REGISTERED' ELSE 'VALIDATED' END
  ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'DATA_MISSING' WHEN '2-HIGH' THEN 'TABLE_NOT_FOUND' WHEN '3-MEDIUM' THEN 'SKIPPED' ELSE 'CREATED' END END AS status,
  o_totalprice, o_orderkey, o_orderpriority FROM orders"""
ITEM_STATUS = {
    "F": ("VALIDATED", "EMPTY_SOURCE", "SKIPPED_VIEW", "COMPLETED"),
    "O": ("FAILED", "SOURCE_NOT_FOUND", "REGISTERED", "VALIDATED"),
    "P": ("DATA_MISSING", "TABLE_NOT_FOUND", "SKIPPED", "CREATED"),
}


def tracked_items(spark: SparkSession, d: str) -> DataFrame:
    status = None
    for mark, (urgent, high, medium, rest) in ITEM_STATUS.items():
        priority = F.col("o_orderpriority")
        value = (F.when(priority == "1-URGENT", urgent).when(priority == "2-HIGH", high)
                 .when(priority == "3-MEDIUM", medium).otherwise(rest))
        test = F.col("o_orderstatus") == mark
        status = F.when(test, value) if status is None else status.when(test, value)
    return read(spark, d, "orders").select(
        F.concat(text("o_custkey"), F.lit("-"), text(F.year("o_orderdate"))).alias("run_id"), status.alias("status"),
        "o_totalprice", "o_orderkey", "o_orderpriority")


def _in(names) -> str:
    return "status IN (" + ", ".join(f"'{n}'" for n in names) + ")" if names else "false"


def _outcome_sql(flow: str) -> str:
    rules = state.FLOWS[flow]
    return f"""SELECT '{flow}' AS flow, run_id, count(*)::BIGINT AS total, count(*) FILTER ({_in(rules['successful'])})::BIGINT AS successful,
  count(*) FILTER ({_in(rules['failed'])})::BIGINT AS failed, count(*) FILTER ({_in(rules['missing'])})::BIGINT AS missing,
  count(*) FILTER (status IN ('SKIPPED', 'SKIPPED_VIEW'))::BIGINT AS skipped,
  CASE WHEN count(*) FILTER ({_in(rules['failed'])}) > 0 THEN '{rules['with_failures']}' WHEN count(*) FILTER ({_in(rules['missing'])}) > 0 THEN 'COMPLETED_WITH_MISSING' ELSE 'COMPLETED' END AS run_status
FROM i GROUP BY run_id"""


@query(f"WITH i AS ({ITEM_SQL}) " + " UNION ALL ".join(_outcome_sql(f) for f in state.FLOWS))
def run_outcome(spark, d):
    # One pass over the items, whatever the number of flows: counts per run and status come first.
    counted = tracked_items(spark, d).groupBy("run_id", "status").agg(F.count(F.lit(1)).alias("n"))
    return state.outcomes_by_flow(counted, list(state.FLOWS), ["run_id"])


@query(f"""WITH i AS ({ITEM_SQL})
SELECT count(*)::BIGINT AS tables, count(*) FILTER ({_in(state.FLOWS['copy']['successful'])})::BIGINT AS successful, count(*) FILTER ({_in(state.FLOWS['copy']['failed'])})::BIGINT AS failed,
  count(*) FILTER ({_in(('SKIPPED', *state.SKIPPABLE))})::BIGINT AS skipped, sum(o_orderkey)::BIGINT AS rows, count(*)::BIGINT AS files,
  round(sum((o_totalprice * 100)::BIGINT) / 1073741824.0::DOUBLE, 6) AS gigabytes, count(*) FILTER (o_orderpriority = '5-LOW')::BIGINT AS incremental FROM i""")
def head_counts(spark, d):
    items = tracked_items(spark, d).select(
        "status", F.col("o_orderkey").alias("source_rows"), F.lit(1).alias("file_count"),
        F.round(F.col("o_totalprice") * 100, 0).cast("bigint").alias("size_bytes"),
        (F.col("o_orderpriority") == "5-LOW").alias("is_incremental"))
    return state.head_counts(items, "copy").withColumn("gigabytes", F.round("gigabytes", 6))


@query(f"WITH i AS ({ITEM_SQL}) SELECT status, o_orderpriority, count(*)::BIGINT AS n FROM i GROUP BY ALL")
def status_counts(spark, d):
    return state.status_counts(tracked_items(spark, d), ["status", "o_orderpriority"])


RAW_ERRORS = (
    ("view", "AnalysisException: Table or view not found: db.t"),
    ("signup", "java.io.FileNotFoundException: s3a://b/x"),
    ("purchase", "AccessDenied (Status Code: 403)"),
    ("click", "ParquetDecodingException: can not read value at 0 in block"),
    ("error", "something  else\n happened"),
)
RAW_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in RAW_ERRORS) + " END"
CODE_SQL = "CASE event_type WHEN 'view' THEN 'TABLE_NOT_FOUND' WHEN 'signup' THEN 'DATA_PATH_MISSING' WHEN 'purchase' THEN 'PERMISSION_DENIED' WHEN 'click' THEN 'SOURCE_DATA_UNREADABLE' ELSE 'MIGRATION_ERROR' END"
LABEL_SQL = "CASE code " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in errors.REASON_LABELS.items()) + " ELSE upper(substr(code, 1, 1))||lower(replace(substr(code, 2), '_', ' ')) END"


def raw_error():
    out = None
    for event, message in RAW_ERRORS:
        test = F.col("event_type") == event
        out = F.when(test, F.lit(message)) if out is None else out.when(test, F.lit(message))
    return out


@query(f"""
WITH m AS (SELECT CASE WHEN value < 60 THEN 'FAILED' ELSE 'SKIPPED' END AS status,
  CASE WHEN value < 30 THEN '['||{CODE_SQL}||'] x' WHEN value < 40 THEN '' WHEN value < 50 THEN 'plain text' ELSE '[ODD_CODE_7] y' END AS msg FROM events),
c AS (SELECT status, msg, regexp_extract(msg, '^\\[([A-Z0-9_]+)\\]', 1) AS code FROM m)
SELECT status, code, CASE WHEN msg = '' THEN 'No reason recorded' WHEN code = '' THEN 'Reason not classified' ELSE {LABEL_SQL} END AS label, count(*)::BIGINT AS n FROM c GROUP BY ALL""")
def reason_breakdown(spark, d):
    value = F.col("value")
    coded = words.reason(errors.migration_code(raw_error()), raw_error())
    message = (F.when(value < 30, coded).when(value < 40, F.lit(" ")).when(value < 50, F.lit("plain text"))
               .otherwise(F.lit("[ODD_CODE_7] y")))
    items = read(spark, d, "events").select(
        F.when(value < 60, "FAILED").otherwise("SKIPPED").alias("status"), message.alias("error_message"))
    return state.reason_breakdown(items)


@query(f"""
SELECT event_id, {CODE_SQL} AS code, CASE event_type WHEN 'view' THEN 'SKIPPED' ELSE 'FAILED' END AS metadata_status,
  CASE WHEN value < 20 THEN 'SOURCE_PATH_NOT_FOUND' ELSE 'FAILED' END AS discovery, event_type = 'error' AS generic,
  '['||{CODE_SQL}||'] '||regexp_replace({RAW_SQL}, '\\s+', ' ', 'g') AS reason FROM events""")
def classify_errors(spark, d):
    raw = raw_error()
    code = errors.migration_code(raw)
    gone = F.when(F.col("value") < 20, F.lit(False)).when(F.col("value") < 60, F.lit(True))
    discovery = errors.discovery_status(F.when(F.col("value") < 20, F.lit("gone")).otherwise(raw), gone)
    return read(spark, d, "events").select(
        "event_id", code.alias("code"), errors.metadata_status(errors.metadata_code(raw)).alias("metadata_status"),
        discovery.alias("discovery"), (code == "MIGRATION_ERROR").alias("generic"), words.reason(code, raw).alias("reason"))


@query("""
WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_suppkey, arg_max(l_returnflag, (n, -ascii(l_returnflag))) AS l_returnflag, max(n)::BIGINT AS n FROM c GROUP BY 1
UNION ALL SELECT -1, * FROM (SELECT l_returnflag, count(*)::BIGINT AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_returnflag LIMIT 1)""")
def dominant_type(spark, d):
    lines = read(spark, d, "lineitem")
    overall = state.dominant(lines, "l_returnflag").select(F.lit(-1).cast("bigint").alias("l_suppkey"), "l_returnflag", "n")
    return state.dominant(lines, "l_returnflag", ["l_suppkey"]).unionByName(overall)


@query("""
WITH g AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (event_type = 'view') AS a, count(*) FILTER (event_type = 'click') AS b,
  count(*) FILTER (event_type = 'error') AS c, count(*) FILTER (event_type = 'signup') AS e, sum(event_id) AS rows, sum(event_id) * 1000 AS bytes FROM events GROUP BY 1, 2)
SELECT user_id, day, round(bytes / 1073741824.0::DOUBLE, 6) AS gigabytes, round(bytes / greatest(b, 1) / 1048576.0::DOUBLE, 6) AS mb_per_second,
  (a + b + c + e)::BIGINT AS total_seconds, round(rows / greatest(a + b + c + e, 1), 6) AS rows_per_second FROM g""")
def table_performance(spark, d):
    kind = F.col("event_type")
    states = read(spark, d, "events").groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count_if(kind == "view").alias("discovery_seconds"), F.count_if(kind == "click").alias("copy_seconds"),
        F.count_if(kind == "error").alias("create_seconds"), F.count_if(kind == "signup").alias("validate_seconds"),
        F.sum("event_id").alias("source_rows"), (F.sum("event_id") * 1000).alias("size_bytes"),
        F.lit("VALIDATED").alias("status"))
    out = state.table_performance(states, ["user_id", "day"])
    for c in ("gigabytes", "mb_per_second", "rows_per_second"):
        out = out.withColumn(c, F.round(c, 6))
    return out


@query("""
WITH f AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WHERE o_orderstatus = 'F')
SELECT o_custkey, max(n)::BIGINT AS failures, string_agg(o_orderkey::VARCHAR, '; ' ORDER BY o_orderkey) FILTER (rn <= 3)||CASE WHEN max(n) > 3 THEN ' (+'||(max(n) - 3)||' more)' ELSE '' END AS preview FROM f GROUP BY 1""")
def preview_failures(spark, d):
    failed = read(spark, d, "orders").where(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderkey")
    return state.failure_preview(failed, ["o_custkey"], "o_orderkey", [F.col("o_orderkey")], shown=3)


@query("""
SELECT user_id, min(epoch(ts)::BIGINT)::BIGINT AS first_epoch, strftime(to_timestamp(min(epoch(ts)::BIGINT)) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS first_text,
  (max(epoch(date_trunc('second', ts))::BIGINT) - min(epoch(date_trunc('second', ts))::BIGINT))::DOUBLE AS seconds FROM (SELECT user_id, date_trunc('second', ts) AS ts FROM events) GROUP BY 1""")
def durations(spark, d):
    spans = read(spark, d, "events").groupBy("user_id").agg(
        keys.utc_text(F.min("ts")).alias("first_text"), keys.utc_text(F.max("ts")).alias("last_text"))
    return spans.select(
        "user_id", F.unix_timestamp("first_text").alias("first_epoch"), "first_text",
        keys.seconds_between("first_text", "last_text").alias("seconds"))


# ------------------------------------------------------------------ files, formats, catalogs

ORDER_ROWS = """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month FROM orders"""


def order_rows(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.date_format("o_orderdate", "yyyy").alias("year"), F.date_format("o_orderdate", "MM").alias("month"))


@query(f"""SELECT year, month, count(*)::BIGINT AS source_rows, count(*)::BIGINT AS dest_rows, true AS same_content, true AS schema_match FROM ({ORDER_ROWS}) GROUP BY 1, 2""")
def convert_verified(spark, d):
    """orders as delimited text, read back, converted to partitioned Parquet and checked per partition."""
    rows = order_rows(spark, d)
    plain = scratch_path(spark, "text")
    datasets.write_delimited(rows, plain, "|")
    source = datasets.read_delimited(spark, plain, rows.schema.simpleString()[7:-1].replace(":", " "), "|")
    out = lifecycle.convert_verified(spark, source, scratch_path(spark, "parquet"), "parquet", ["year", "month"])
    return out.drop("differences")


@query(f"""
WITH o AS ({ORDER_ROWS}), s AS (SELECT DISTINCT year, month, 'year='||year||'/month='||month AS spec FROM o),
w AS (SELECT spec FROM (SELECT spec, row_number() OVER (ORDER BY spec DESC) AS rn FROM s) WHERE rn <= 10 UNION SELECT spec FROM s WHERE year = '1997')
SELECT spec, true AS copied, count(o_orderkey)::BIGINT AS row_count FROM o JOIN w ON w.spec = 'year='||o.year||'/month='||o.month GROUP BY 1
UNION ALL SELECT 'year=1901/month=01', false, 0""")
def copy_partitions(spark, d):
    rows = order_rows(spark, d)
    specs = rows.select(F.lit("db").alias("db"), F.lit("orders").alias("tbl"),
                        partitions.make_spec("year", "month").alias("spec")).distinct()
    chosen = partitions.select_partitions(specs, "last_n_partitions=10, year=1997/*").select("spec")
    chosen = chosen.unionByName(spark.createDataFrame([("year=1901/month=01",)], "spec string"))
    path = scratch_path(spark, "copied")
    report = lifecycle.copy_partitions(rows, chosen, path, ["year", "month"])
    there = partitions.partition_counts(datasets.read_parquet_tree(spark, path), ["year", "month"]).select("spec", "row_count")
    return report.join(there, "spec", "left").select("spec", "copied", F.coalesce("row_count", F.lit(0)).alias("row_count"))


@query(f"""
WITH o AS ({ORDER_ROWS})
SELECT o_orderstatus AS tbl, count(DISTINCT year||month)::BIGINT AS partitions, 'CONFIRMED' AS presence FROM o GROUP BY 1 UNION ALL SELECT 'X', 0, 'MISSING'""")
def presence(spark, d):
    """orders written as one folder per status with a metadata file each; one expected folder is absent."""
    root = scratch_path(spark, "lake")
    rows = order_rows(spark, d)
    named = rows.select("o_orderkey", "o_orderstatus", "year", "month")
    lifecycle.write_partitioned(named, root, ["o_orderstatus", "year", "month"])
    marks = named.select("o_orderstatus", F.lit("metadata").alias("value")).distinct()
    marks.write.partitionBy("o_orderstatus").mode("append").text(root + "_meta")
    found = files.file_inventory(spark, root)
    tables = files.partition_files(found).withColumn("tbl", F.regexp_extract("spec", "^o_orderstatus=([^/]*)", 1))
    totals = tables.groupBy("tbl").agg(F.count(F.lit(1)).alias("file_count"), F.count_distinct("spec").alias("partitions"))
    meta = files.partition_files(files.file_inventory(spark, root + "_meta")).select(
        F.regexp_extract("spec", "^o_orderstatus=([^/]*)", 1).alias("tbl"), F.lit(True).alias("has_meta")).distinct()
    wanted = rows.select(F.col("o_orderstatus").alias("tbl")).distinct().unionByName(
        spark.createDataFrame([("X",)], "tbl string"))
    both = wanted.join(totals, "tbl", "left").join(meta, "tbl", "left")
    verdict = reconcile.presence_verdict(F.col("file_count").isNotNull(), F.coalesce("has_meta", F.lit(False)), "file_count")
    return both.select("tbl", F.coalesce("partitions", F.lit(0)).alias("partitions"), verdict.alias("presence"))


@query(f"""
WITH o AS ({ORDER_ROWS}) SELECT 'orders_ext' AS tbl, 'VALIDATED' AS status, count(*)::BIGINT AS table_rows, count(*)::BIGINT AS file_rows,
  count(DISTINCT year||month)::BIGINT AS registered_partitions, count(DISTINCT year||month)::BIGINT AS written_partitions FROM o""")
def register_and_repair(spark, d):
    path = scratch_path(spark, "registered")
    lifecycle.write_partitioned(order_rows(spark, d), path, ["year", "month"])
    spark.sql("DROP TABLE IF EXISTS tablekit_demo.orders_ext")
    return lifecycle.register_parquet(spark, "tablekit_demo", "orders_ext", path).select(
        "tbl", "status", "table_rows", "file_rows", "registered_partitions", "written_partitions")


SNAP = """SELECT c_custkey, c_nationkey, c_acctbal > 0 AS moved, c_mktsegment FROM customer"""


@query(f"""
SELECT 'c'||c_custkey AS tbl, 2::BIGINT AS format_version, 2::BIGINT AS dest_snapshots, CASE WHEN moved THEN 0 ELSE 1 END::BIGINT AS stale_snapshots, moved AS rewrite_ok,
  c_custkey::BIGINT AS row_count, 'id BIGINT, seg STRING, n DECIMAL(9,2), s STRUCT<a:INT,b:ARRAY<STRING>>' AS columns, 'id/bucket/'||(c_nationkey + 1) AS spec FROM ({SNAP})""")
def metadata_snapshot(spark, d):
    """One metadata document per customer, written out and read back: schema, spec, snapshots, rewrite check."""
    root = scratch_path(spark, "meta")
    rows = read(spark, d, "customer").select("c_custkey", "c_nationkey", (F.col("c_acctbal") > 0).alias("moved"))
    old = F.when(F.col("moved"), F.lit("s3a://new/")).otherwise(F.lit("s3a://old/"))
    doc = F.concat(
        F.lit('{"format-version":2,"current-schema-id":1,"default-spec-id":0,"current-snapshot-id":7,"schemas":['
              '{"schema-id":0,"fields":[]},{"schema-id":1,"fields":[{"id":1,"name":"id","type":"long"},'
              '{"id":2,"name":"seg","type":"uuid"},{"id":3,"name":"n","type":"decimal(9,2)"},'
              '{"id":4,"name":"s","type":{"type":"struct","fields":[{"name":"a","type":"int"},'
              '{"name":"b","type":{"type":"list","element":"string"}}]}}]}],'
              '"partition-specs":[{"spec-id":0,"fields":[{"name":"id_b","source-id":1,"transform":"bucket['),
        text(F.col("c_nationkey") + 1), F.lit(']"}]}],"snapshots":[{"snapshot-id":6,"manifest-list":"'), old,
        F.lit('m6","summary":{"total-records":"1"}},{"snapshot-id":7,"manifest-list":"s3a://new/m7","summary":{"total-records":"'),
        text("c_custkey"), F.lit('"}}]}'))
    rows.select(F.concat(F.lit("c"), text("c_custkey")).alias("tbl"), doc.alias("value")).write.parquet(root)
    written = spark.read.parquet(root)
    parsed = written.select("tbl", F.from_json("value", T.StructType.fromDDL(metadata.DOCUMENT_DDL)).alias("_d"))
    docs = parsed.select("tbl", "_d.*")
    facts = metadata.snapshot_facts(docs).select("tbl", "format_version", "row_count")
    cols = metadata.schema_columns(docs).groupBy("tbl").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("pos", "name", "type"))), lambda x: F.concat_ws(" ", x["name"], x["type"])), ", ").alias("columns"))
    spec = metadata.partition_fields(docs).select(
        "tbl", F.concat_ws("/", "source_column", "transform", text("param")).alias("spec"))
    expected = docs.select("tbl", F.lit("s3a://old/").alias("source_prefix"), F.lit("s3a://new").alias("dest_prefix"),
                           F.lit(2).alias("source_snapshots"))
    check = metadata.check_rewrite(metadata.snapshots(docs), expected).select(
        "tbl", "dest_snapshots", "stale_snapshots", "rewrite_ok")
    out = facts.join(check, "tbl").join(cols, "tbl").join(spec, "tbl")
    return out.withColumn("format_version", F.col("format_version").cast("bigint"))


@query("""
SELECT 'run_20240101_000000_0123abcd' AS run_id, user_id, max(floor(value / 25))::BIGINT AS attempt, count(*)::BIGINT AS records FROM events GROUP BY 2""")
def checkpoint_files(spark, d):
    """events as checkpoint records, written as JSON in one job and read back for the run."""
    path, run = scratch_path(spark, "checkpoints"), "run_20240101_000000_0123abcd"
    records = read(spark, d, "events").select(
        F.lit(run).alias("run_id"), text("user_id").alias("source_table"),
        F.floor(F.col("value") / 25).cast("int").alias("attempt"), F.lit("COMPLETED").alias("status"))
    checkpoints.write_checkpoints(records, path)
    return checkpoints.read_checkpoints(spark, path, run).groupBy(
        "run_id", F.col("source_table").cast("bigint").alias("user_id")).agg(
        F.max("attempt").cast("bigint").alias("attempt"), F.count(F.lit(1)).alias("records"))


@query("""
WITH s AS (SELECT s_suppkey AS k, row_number() OVER (ORDER BY s_suppkey) - 1 AS row_index FROM supplier)
SELECT row_index::BIGINT AS row_index, 'db'||(k % 7) AS database,
  CASE k % 5 WHEN 0 THEN 'a "quoted" name, '||k WHEN 1 THEN 'first'||chr(10)||'second, '||k WHEN 2 THEN '""'||k||chr(10)||chr(10)||'"' WHEN 3 THEN k||' 5" wide' ELSE 't'||k END AS "table",
  CASE WHEN k % 3 <> 0 THEN 'line'||chr(10)||'break' END AS dest_database FROM s""")
def sheet_with_line_breaks(spark, d):
    """supplier as several CSV sheets whose cells hold line breaks, commas and quotes, cut into small pieces."""
    k = F.col("s_suppkey")
    def word(*pieces):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in pieces])

    cell = (F.when(k % 5 == 0, word('a "quoted" name, ', k)).when(k % 5 == 1, word("first\nsecond, ", k))
            .when(k % 5 == 2, word('""', k, '\n\n"')).when(k % 5 == 3, word(k, ' 5" wide')).otherwise(word("t", k)))
    rows = read(spark, d, "supplier").select(k.alias("k"), word("db", k % 7).alias("db"), cell.alias("tbl"), F.when(
        k % 3 != 0, F.lit("line\nbreak")).alias("dest"))
    quoted = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in ("db", "tbl")]
    line = F.concat_ws(",", quoted[0], F.when(F.col("k") % 5 == 3, F.col("tbl")).otherwise(quoted[1]),
                       F.coalesce(F.concat(F.lit('"'), "dest", F.lit('"')), F.lit("")), F.lit("bucket"))
    head = F.lit("Database,Table,Dest Database,Bucket")
    path = scratch_path(spark, "sheets")
    files = rows.select(F.floor(F.col("k") / 400).alias("part"), "k", line.alias("line"))  # a file of bounded size each
    files.groupBy("part").agg(F.concat_ws("\n", head, F.transform(F.sort_array(F.collect_list(F.struct("k", "line"))), lambda x: x["line"])).alias("value")).select(
        F.lpad(F.col("part").cast("string"), 9, "0").alias("file"), "value").repartitionByRange("file").write.partitionBy("file").text(path)
    with small_pieces(spark):
        return sheets.read_manifest(spark, path, "table_copy").select("row_index", "database", "table", "dest_database")


@contextmanager
def small_pieces(spark, size: str = "8k"):
    """Files cut into pieces of this size."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, size)
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


@query("""
SELECT c_mktsegment AS database, count(*)::BIGINT AS rows, count(*) FILTER (c_acctbal >= 0)::BIGINT AS with_dest FROM customer GROUP BY 1""")
def sheet_round_trip(spark, d):
    """customer written as a CSV sheet with untidy headers and read as a table-copy manifest."""
    path = scratch_path(spark, "sheet")
    read(spark, d, "customer").select(
        F.col("c_mktsegment").alias(" Database"), F.col("c_name").alias("Table "),
        F.when(F.col("c_acctbal") >= 0, F.lit("dw")).alias("Dest Database"), F.lit("b").alias("bucket")).write.option(
        "header", True).csv(path)
    sheet = sheets.read_manifest(spark, path, "table_copy")
    return sheet.groupBy("database").agg(F.count(F.lit(1)).alias("rows"), F.count("dest_database").alias("with_dest"))


@query(f"""
WITH l AS (SELECT l_returnflag, {"'year='||strftime(l_shipdate,'%Y')||'/month='||strftime(l_shipdate,'%m')"} AS spec, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, row_number() OVER (PARTITION BY 1 ORDER BY n DESC, l_returnflag, spec) - 1 AS rank, spec, n::BIGINT AS n FROM l""")
def rank_by_size(spark, d):
    counted = read(spark, d, "lineitem").groupBy("l_returnflag", month_spec("l_shipdate").alias("spec")).agg(
        F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("l_returnflag"), F.col("spec")]
    return ordered.number_rows(counted, [-F.col("n"), F.col("l_returnflag")], order, "rank")
