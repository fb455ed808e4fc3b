"""Copy planning over the sample tables: sync, cost, packing, splitting, attempts, diagnosis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics
from ..functions.text import mapping_name, mapping_principal, mapping_role
from ..operators import copyplan, reconcile, state
from ..session import materialize
from .base import read, text
from .moving import page_urls

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn
    return add


# ------------------------------------------------------------------ file sync

DOC_PATH = "source||'/'||lang||'/'||doc_id||'.txt'"
SYNC = f"""
WITH s AS (SELECT {DOC_PATH} AS p, source AS folder, n_chars AS n FROM documents),
t AS (SELECT {DOC_PATH} AS p, source AS folder, CASE WHEN source = 'src3' THEN n_chars + 1 ELSE n_chars END AS n FROM documents WHERE lang <> 'de'
  UNION ALL SELECT 'src1/extra/'||item_id||'.txt', 'src1', length(text) FROM benchmark),
j AS (SELECT coalesce(s.p, t.p) AS rel_path, coalesce(s.folder, t.folder) AS folder, s.n AS source_size, t.n AS dest_size,
  CASE WHEN s.p IS NULL THEN 'DELETE' WHEN t.p IS NULL OR s.n <> t.n THEN 'COPY' ELSE 'SKIP' END AS action FROM s FULL JOIN t ON s.p = t.p)"""


def document_files(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """documents as files, and a destination that lacks one language, has other sizes in one folder
    and some files of its own."""
    docs = read(spark, d, "documents").select(
        F.concat_ws("/", "source", "lang", F.concat(text("doc_id"), F.lit(".txt"))).alias("rel_path"),
        F.col("source").alias("folder"), "lang", F.col("n_chars").alias("length"))
    changed = F.when(F.col("folder") == "src3", F.col("length") + 1).otherwise(F.col("length"))
    extra = read(spark, d, "benchmark").select(
        F.concat(F.lit("src1/extra/"), text("item_id"), F.lit(".txt")).alias("rel_path"), F.lit("src1").alias("folder"),
        F.length("text").cast("bigint").alias("length"))
    dest = docs.where(F.col("lang") != "de").withColumn("length", changed).drop("lang").unionByName(extra)
    return docs.drop("lang"), dest


@query(f"""{SYNC}
SELECT folder, rel_path, source_size, dest_size, action,
  (CASE action WHEN 'COPY' THEN source_size WHEN 'DELETE' THEN dest_size ELSE 0 END)::BIGINT AS bytes FROM j""")
def file_sync_plan(spark, d):
    source, dest = document_files(spark, d)
    return copyplan.sync_plan(source, dest, ["folder"], delete=True)


FOLDERS = f"""{SYNC},
f AS (SELECT folder, count(source_size) AS sf, coalesce(sum(source_size), 0) AS sb, count(dest_size) AS df, coalesce(sum(dest_size), 0) AS db FROM j GROUP BY 1)"""


def folder_totals(spark: SparkSession, d: str) -> DataFrame:
    source, dest = document_files(spark, d)
    plan = copyplan.sync_plan(source, dest, ["folder"], delete=True)
    return plan.groupBy("folder").agg(
        F.count("source_size").alias("source_files"), F.coalesce(F.sum("source_size"), F.lit(0)).alias("source_bytes"),
        F.count("dest_size").alias("dest_files"), F.coalesce(F.sum("dest_size"), F.lit(0)).alias("dest_bytes"))


@query(f"""{FOLDERS}
SELECT folder, sf = df AS file_count_match, abs(sb - db) <= greatest(1, floor(sb * 0.01)) AS size_match,
  CASE WHEN folder = 'src2' THEN 'VALIDATION_SKIPPED' WHEN folder = 'src5' THEN 'EMPTY_SOURCE'
       WHEN sf = df AND abs(sb - db) <= greatest(1, floor(sb * 0.01)) THEN 'VALIDATED' ELSE 'VALIDATION_FAILED' END AS status FROM f""")
def folder_validation(spark, d):
    copied = F.when(F.col("folder") == "src2", "FAILED").when(F.col("folder") == "src5", "EMPTY_SOURCE").otherwise("COMPLETED")
    return folder_totals(spark, d).select(
        "folder", (F.col("source_files") == F.col("dest_files")).alias("file_count_match"),
        metrics.size_matches("source_bytes", "dest_bytes").alias("size_match"),
        copyplan.folder_validation(copied, F.lit(True), "source_files", "dest_files", "source_bytes", "dest_bytes")
        .alias("status"))


@query(f"""{FOLDERS}
SELECT count(*)::BIGINT AS copies, count(*) FILTER (sb = db)::BIGINT AS size_matches, count(*) FILTER (sb <> db)::BIGINT AS size_mismatches,
  count(*) FILTER (sf = df)::BIGINT AS file_count_matches, count(*) FILTER (sf <> df)::BIGINT AS file_count_mismatches,
  sum(sb)::BIGINT AS source_bytes, sum(db)::BIGINT AS dest_bytes, round(abs(sum(sb) - sum(db)) / sum(sb)::DOUBLE * 100, 4) AS difference_percent FROM f""")
def transfer_summary(spark, d):
    copies = folder_totals(spark, d).withColumn("size_match", F.col("source_bytes") == F.col("dest_bytes")).withColumn(
        "file_count_match", F.col("source_files") == F.col("dest_files"))
    out = reconcile.transfer_summary(copies)
    return out.withColumn("difference_percent", F.round("difference_percent", 4))


@query(f"""{FOLDERS}
SELECT folder, (sf - df)::BIGINT AS files_transferred, (sb - db)::BIGINT AS bytes_transferred, df > 0 AS is_incremental FROM f""")
def copy_deltas(spark, d):
    totals = folder_totals(spark, d)
    before = totals.select("folder", F.col("dest_files").alias("file_count"), F.col("dest_bytes").alias("size_bytes"))
    after = totals.select("folder", F.col("source_files").alias("file_count"), F.col("source_bytes").alias("size_bytes"))
    return copyplan.transferred(before, after, ["folder"]).select(
        "folder", "files_transferred", "bytes_transferred", "is_incremental")


# ------------------------------------------------------------------ cost and batches

VOLUMES = """
WITH v AS (SELECT 'sup_'||l_suppkey AS db, strftime(l_shipdate, '%Y-%m') AS tbl, count(*) AS files, sum(l_quantity::BIGINT) * 104857600 AS bytes,
  count(*) FILTER (l_returnflag = 'A') AS ffiles, coalesce(sum(l_quantity::BIGINT) FILTER (l_returnflag = 'A'), 0) * 104857600 AS fbytes,
  count(DISTINCT CASE WHEN l_returnflag = 'A' THEN l_shipdate END) AS paths,
  count(DISTINCT CASE WHEN l_returnflag = 'A' AND l_quantity > 10 THEN l_shipdate END) AS jobs,
  max(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) = 1 AS active, min(l_quantity) >= 49 AS failed FROM lineitem GROUP BY ALL),
e AS (SELECT *, CASE WHEN active THEN fbytes ELSE bytes END AS eb, CASE WHEN active THEN ffiles ELSE files END AS ef,
  CASE WHEN active THEN paths ELSE 1 END AS ep, CASE WHEN active THEN jobs ELSE 1 END AS ej FROM v),
c AS (SELECT *, CASE WHEN failed THEN 0.0 WHEN active AND paths = 0 THEN 30.0 WHEN ef = 0 THEN 30.0 + 2 * ep
  ELSE 30.0::DOUBLE + eb::DOUBLE / (150 * 1048576.0::DOUBLE) + 45 * ej + 24 * ep + ef * 0.002::DOUBLE END::DOUBLE AS cost FROM e)"""


#: Lines that one task adds up, so that its memory stays the same however many there are.
LINES_A_TASK = 100_000


def table_volumes(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as one table per supplier and month; flag A stands for the selected partitions."""
    chosen = F.col("l_returnflag") == "A"
    size = F.col("l_quantity").cast("bigint") * 104_857_600
    lines = read(spark, d, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity", "l_returnflag")
    tasks = lines.count() // LINES_A_TASK + 1
    # a row per path first: distinct paths side by side would be counted over three copies of each row
    paths = lines.repartition(tasks, "l_suppkey", "l_shipdate").groupBy("l_suppkey", "l_shipdate").agg(
        F.count(F.lit(1)).alias("files"), F.sum(size).alias("bytes"),
        F.count_if(chosen).alias("chosen_files"), F.sum(F.when(chosen, size)).alias("chosen_bytes"),
        F.max(chosen & (F.col("l_quantity") > 10)).alias("nonempty"),
        F.max(F.col("l_returnflag") == "N").alias("active"), F.min("l_quantity").alias("least"))
    dated = F.col("l_shipdate").isNotNull()
    tables = paths.withColumn("db", F.concat(F.lit("sup_"), text("l_suppkey"))).withColumn(
        "tbl", F.date_format("l_shipdate", "yyyy-MM"))
    return tables.repartition(tasks, "db", "tbl").groupBy("db", "tbl").agg(
        F.sum("files").alias("file_count"), F.sum("bytes").alias("size_bytes"),
        F.sum("chosen_files").alias("filtered_files"), F.coalesce(F.sum("chosen_bytes"), F.lit(0)).alias("filtered_bytes"),
        F.count_if(dated & (F.col("chosen_files") > 0)).alias("selected_paths"),
        F.count_if(dated & F.col("nonempty")).alias("nonempty_paths"),
        F.max("active").alias("filter_active"), (F.min("least") >= 49).alias("failed"))


@query(f"{VOLUMES} SELECT db, tbl, eb::BIGINT AS effective_bytes, ef::BIGINT AS effective_files, round(cost, 3) AS cost FROM c")
def copy_cost(spark, d):
    out = copyplan.with_cost(table_volumes(spark, d))
    return out.select(
        "db", "tbl", metrics.effective("filter_active", "filtered_bytes", "size_bytes").alias("effective_bytes"),
        metrics.effective("filter_active", "filtered_files", "file_count").alias("effective_files"),
        F.round("cost", 3).alias("cost"))


@query(f"""{VOLUMES}
SELECT round(sum(cost), 0) AS total_cost, round(least(0.9 * 28800 / 1.25, sum(cost) / 6), 0) AS cap, 20736.0::DOUBLE AS ceiling FROM c""")
def batch_cap(spark, d):
    out = copyplan.resolve_cap(copyplan.with_cost(table_volumes(spark, d)), lanes=3, backstop_seconds=28_800)
    return out.select(F.round("total_cost", 0).alias("total_cost"), F.round("cap", 0).alias("cap"),
                      metrics.batch_cap(F.lit(0.0), 0, 28_800).alias("ceiling"))


def _packed(spark: SparkSession, d: str) -> DataFrame:
    costed = copyplan.with_cost(table_volumes(spark, d)).select("db", "tbl", "cost")
    ceiling = metrics.BATCH_BUDGET_FRACTION * 28_800 / metrics.BUDGET_SLACK
    return copyplan.pack_batches(costed, cap=ceiling / 10, max_tables=25)


# First-fit-decreasing stated step by step: the open batches' room and free places of a database are two lists.
@query(f"""{VOLUMES.replace("WITH", "WITH RECURSIVE", 1)},
o AS (SELECT db, tbl, cost, row_number() OVER (PARTITION BY db ORDER BY cost DESC, tbl) AS i FROM c),
k AS (SELECT {metrics.BATCH_BUDGET_FRACTION} * 28800 / {metrics.BUDGET_SLACK} / 10 AS cap),
r AS (SELECT DISTINCT db, 0::BIGINT AS i, []::DOUBLE[] AS room, []::BIGINT[] AS free, 0::BIGINT AS bin FROM c
  UNION ALL SELECT db, i + 1, CASE WHEN j IS NULL THEN list_append(room, cap - cost) ELSE list_transform(room, lambda x, n: CASE WHEN n = j THEN x - cost ELSE x END) END,
    CASE WHEN j IS NULL THEN list_append(free, 24) ELSE list_transform(free, lambda x, n: CASE WHEN n = j THEN x - 1 ELSE x END) END, coalesce(j - 1, len(room))
  FROM (SELECT r.*, o.cost, k.cap, list_filter(range(1, len(r.room) + 1), lambda n: r.room[n] >= o.cost AND r.free[n] > 0)[1] AS j
        FROM r JOIN o ON o.db = r.db AND o.i = r.i + 1, k)),
p AS (SELECT o.db, o.tbl, o.cost, r.bin FROM o JOIN r ON r.db = o.db AND r.i = o.i)
SELECT db||'/0/'||bin AS batch, db, tbl, round(cost, 3) AS cost, round(sum(cost) OVER (PARTITION BY db, bin), 3) AS batch_cost,
  count(*) OVER (PARTITION BY db, bin)::BIGINT AS batch_tables FROM p""")
def pack_batches(spark, d):
    return _packed(spark, d).select("batch", "db", "tbl", F.round("cost", 3).alias("cost"),
                                    F.round("batch_cost", 3).alias("batch_cost"), "batch_tables")


@query(f"""{VOLUMES}
SELECT db, count(*)::BIGINT AS tables, round(sum(cost), 0) AS cost, 0::BIGINT AS over_cap, 0::BIGINT AS over_count FROM c GROUP BY 1""")
def pack_totals(spark, d):
    """What packing must keep: every table once, all cost, no batch of several tables over a limit."""
    several = F.col("batch_tables") > 1
    cap = metrics.BATCH_BUDGET_FRACTION * 28_800 / metrics.BUDGET_SLACK / 10
    return _packed(spark, d).groupBy("db").agg(
        F.count_distinct("tbl").alias("tables"), F.round(F.sum("cost"), 0).alias("cost"),
        F.count_if(several & (F.col("batch_cost") > cap + 1e-6)).alias("over_cap"),
        F.count_if(F.col("batch_tables") > 25).alias("over_count"))


@query(f"""{VOLUMES},
k AS (SELECT db, tbl FROM c WHERE cost > 500 UNION ALL SELECT DISTINCT db, 'none' FROM c)
SELECT k.db, k.tbl, c.tbl IS NOT NULL AS answered, round(c.cost, 3) AS cost FROM k LEFT JOIN c USING (db, tbl)""")
def batch_members(spark, d):
    costed = materialize(copyplan.with_cost(table_volumes(spark, d)).select("db", "tbl", F.round("cost", 3).alias("cost")), "costs")
    keys = costed.where(F.col("cost") > 500).select("db", "tbl").unionByName(
        costed.select("db", F.lit("none").alias("tbl")).distinct())
    found, unmatched = copyplan.batch_members(keys, costed, ["db", "tbl"])
    return found.select("db", "tbl", F.lit(True).alias("answered"), "cost").unionByName(
        unmatched.select("db", "tbl", F.lit(False).alias("answered"), F.lit(None).cast("double").alias("cost")))


@query("""
WITH f AS (SELECT regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS root, regexp_extract(url, '^[a-z]+://[^/]*/([^?#]*)', 1) AS p, length(html) AS n FROM pages),
g AS (SELECT root, string_split(p, '/') AS s, p, n FROM f UNION ALL SELECT root, ['index.html'], 'index.html', 10 FROM f WHERE n > 3000
  UNION ALL SELECT root, ['deep', 'er', 'x'], 'deep/er/x', 5 FROM f WHERE n > 2000),
u AS (SELECT root, CASE WHEN len(s) = 1 THEN '' WHEN len(s) = 2 THEN s[1] ELSE s[1]||'/'||s[2] END AS unit,
  CASE WHEN len(s) - 1 < 2 THEN 'loose_files' ELSE 'subfolder' END AS role, n FROM g),
a AS (SELECT root, unit, role, count(*) AS file_count, sum(n) AS size_bytes FROM u GROUP BY ALL),
b AS (SELECT root, unit, CASE WHEN role = 'loose_files' AND unit <> '' AND NOT EXISTS (SELECT 1 FROM a x WHERE x.root = a.root AND starts_with(x.unit, a.unit||'/')) THEN 'subfolder' ELSE role END AS role,
  file_count, size_bytes FROM a),
s AS (SELECT root, count(*) FILTER (role <> 'loose_files') = 0 AS whole, count(*) > 8 OR coalesce(max(file_count) FILTER (role = 'loose_files'), 0) > 6 AS over_limit FROM b GROUP BY 1)
SELECT root, unit, role, file_count::BIGINT AS file_count, size_bytes::BIGINT AS size_bytes, over_limit FROM b JOIN s USING (root) WHERE NOT whole
UNION ALL SELECT root, '', 'whole', sum(file_count)::BIGINT, sum(size_bytes)::BIGINT, any_value(over_limit) FROM b JOIN s USING (root) WHERE whole GROUP BY 1""")
def folder_split(spark, d):
    urls = page_urls(spark, d)
    files = urls.select(F.col("host").alias("root"), F.regexp_extract("clean", "^[a-z]+://[^/]*/(.*)$", 1).alias("rel_path"),
                        F.col("size").alias("length"))
    loose = files.where(F.col("length") > 3000).select("root", F.lit("index.html").alias("rel_path"), F.lit(10).cast("bigint").alias("length"))
    deep = files.where(F.col("length") > 2000).select("root", F.lit("deep/er/x").alias("rel_path"), F.lit(5).cast("bigint").alias("length"))
    return copyplan.split_folders(files.unionByName(loose).unionByName(deep), depth=2, max_units=8, max_loose=6)


# ------------------------------------------------------------------ checkpoints and outcomes

KEY = "sha256(to_json([source, lang, doc_id::VARCHAR, NULL])::VARCHAR)"


@query(f"""
WITH u AS (SELECT doc_id, {KEY} AS checkpoint_key FROM documents),
k AS (SELECT u.checkpoint_key, CASE WHEN toxic = 1 THEN 'FAILED' WHEN quality = 1 THEN 'COMPLETED' ELSE 'RUNNING' END AS status FROM labels JOIN u USING (doc_id)),
done AS (SELECT * FROM k WHERE status = 'COMPLETED')
SELECT u.doc_id, u.checkpoint_key, CASE WHEN d.status IS NULL THEN 'TODO' ELSE 'REUSE' END AS plan FROM u LEFT JOIN done d USING (checkpoint_key)""")
def resume_todo(spark, d):
    units = copyplan.checkpoint_key(
        read(spark, d, "documents").select("doc_id", "lang", "source", F.lit(None).cast("string").alias("partition_filter")),
        ["source", "lang", "doc_id", "partition_filter"]).select("doc_id", "checkpoint_key")
    status = F.when(F.col("toxic") == 1, "FAILED").when(F.col("quality") == 1, "COMPLETED").otherwise("RUNNING")
    last = read(spark, d, "labels").join(units, "doc_id").select("doc_id", "checkpoint_key", status.alias("status"),
                                                                  F.lit(2).alias("attempt"))
    first = last.select("doc_id", "checkpoint_key", F.lit("FAILED").alias("status"), F.lit(1).alias("attempt"))
    todo, reuse = copyplan.resume(units, first.unionByName(last))
    return todo.withColumn("plan", F.lit("TODO")).unionByName(
        reuse.select("doc_id", "checkpoint_key", F.lit("REUSE").alias("plan")))


@query("""
SELECT doc_id, CASE WHEN lang = 'de' THEN 'SOURCE_NOT_FOUND' WHEN source = 'src1' THEN 'FAILED' WHEN source = 'src2' THEN 'SKIPPED'
  WHEN n_chars < 100 THEN 'EMPTY_SOURCE' WHEN source = 'src4' THEN 'FAILED' ELSE 'COMPLETED' END AS status FROM documents""")
def unit_outcomes(spark, d):
    source = F.col("source")
    files = F.when(F.col("n_chars") < 100, 0).otherwise(1)
    status = copyplan.unit_outcome(
        F.when(source == "src1", "lost connection"), F.col("lang") != "de", files,
        F.when(source == "src2", 0), source != "src4")
    return read(spark, d, "documents").select("doc_id", status.alias("status"))


ATTEMPT = """SELECT 'run' AS run_id, 'u'||user_id AS tbl, event_type AS dest, CASE WHEN event_id > 100 THEN '' ELSE NULL END AS pf,
  floor(value / 10)::INT AS attempt, event_type IN ('view', 'click') AND value > 30 AS is_checkpoint, event_id AS seq,
  CASE WHEN value < 20 THEN 'RUNNING' WHEN value < 120 THEN 'COMPLETED' ELSE 'FAILED' END AS status FROM events"""


def attempts(spark: SparkSession, d: str) -> DataFrame:
    value = F.col("value")
    return read(spark, d, "events").select(
        F.concat(F.lit("u"), text("user_id")).alias("source_table"), F.col("event_type").alias("dest_database"),
        F.when(F.col("event_id") > 100, F.lit("")).alias("partition_filter"),
        F.floor(value / 10).cast("int").alias("attempt"),
        (F.col("event_type").isin("view", "click") & (value > 30)).alias("is_checkpoint"),
        F.col("event_id").alias("seq"),
        F.when(value < 20, "RUNNING").when(value < 120, "COMPLETED").otherwise("FAILED").alias("status"),
        F.lit(None).cast("string").alias("error_message"))


@query(f"""
WITH a AS ({ATTEMPT}), r AS (SELECT *, row_number() OVER (PARTITION BY tbl, dest, coalesce(pf, '') ORDER BY attempt DESC, is_checkpoint DESC, seq DESC) AS rn FROM a)
SELECT tbl AS source_table, dest AS dest_database, coalesce(pf, '') AS partition_filter, attempt::BIGINT AS attempt, seq,
  CASE WHEN status = 'RUNNING' THEN 'FAILED' ELSE status END AS status,
  CASE WHEN status = 'RUNNING' THEN 'Attempt '||attempt||' was interrupted before it ended' END AS error_message FROM r WHERE rn = 1""")
def latest_attempt(spark, d):
    rows = attempts(spark, d).withColumn("partition_filter", F.coalesce("partition_filter", F.lit("")))
    out = state.settle_attempts(rows, ["source_table", "dest_database", "partition_filter"])
    return out.select("source_table", "dest_database", "partition_filter", F.col("attempt").cast("bigint").alias("attempt"),
                      "seq", "status", "error_message")


RESULTS = """
WITH t AS (SELECT DISTINCT user_id, event_type, CASE WHEN user_id < 40 THEN 'f'||(event_id % 3) ELSE NULL END AS pf FROM events),
s AS (SELECT user_id, event_type, '' AS pf, sum(CASE WHEN value > 50 THEN event_id ELSE 0 END) AS bytes, floor(max(value))::BIGINT AS files FROM events WHERE user_id < 100 GROUP BY 1, 2
  UNION ALL SELECT user_id, event_type, 'f1', count(*), count(*) FROM events WHERE user_id < 20 GROUP BY 1, 2)"""


@query(f"""{RESULTS},
loose AS (SELECT user_id, event_type, min_by((bytes, files), pf) AS p FROM s GROUP BY 1, 2)
SELECT t.user_id, t.event_type, coalesce(t.pf, '') AS partition_filter,
  (CASE WHEN s.pf IS NOT NULL THEN s.bytes ELSE p[1] END)::BIGINT AS bytes_copied, (CASE WHEN s.pf IS NOT NULL THEN s.files ELSE p[2] END)::BIGINT AS files_copied,
  CASE WHEN s.pf IS NOT NULL THEN 'slice' WHEN p IS NOT NULL THEN 'table' ELSE 'none' END AS matched_by
FROM t LEFT JOIN s ON s.user_id = t.user_id AND s.event_type = t.event_type AND s.pf = coalesce(t.pf, '')
LEFT JOIN loose l ON l.user_id = t.user_id AND l.event_type = t.event_type""")
def attach_results(spark, d):
    events = read(spark, d, "events")
    part = F.when(F.col("user_id") < 40, F.concat(F.lit("f"), text(F.col("event_id") % 3)))
    tables = events.select("user_id", "event_type", part.alias("partition_filter")).distinct()
    results = events.where(F.col("user_id") < 100).groupBy("user_id", "event_type").agg(
        F.lit(None).cast("string").alias("partition_filter"),
        F.sum(F.when(F.col("value") > 50, F.col("event_id")).otherwise(0)).alias("bytes_copied"),
        F.floor(F.max("value")).cast("bigint").alias("files_copied"))
    sliced = events.where(F.col("user_id") < 20).groupBy("user_id", "event_type").agg(
        F.lit("f1").alias("partition_filter"), F.count(F.lit(1)).alias("bytes_copied"), F.count(F.lit(1)).alias("files_copied"))
    return state.attach_results(tables, results.unionByName(sliced), ["user_id", "event_type", "partition_filter"],
                                ["user_id", "event_type"], ["bytes_copied", "files_copied"])


@query("""
WITH s AS (SELECT user_id, event_type, sum(CASE WHEN value > 60 THEN 1 ELSE 0 END) AS rows, min(event_id) AS seq FROM events GROUP BY 1, 2)
SELECT user_id, event_type, rows::BIGINT AS source_rows, CASE WHEN event_type = 'error' THEN 'FAILED' WHEN rows = 0 THEN 'EMPTY_SOURCE' ELSE 'COMPLETED' END AS status FROM s""")
def empty_sources(spark, d):
    tables = read(spark, d, "events").groupBy("user_id", "event_type").agg(F.count_if(F.col("value") > 60).alias("source_rows"))
    done = F.when(F.col("event_type") == "error", "FAILED").otherwise("COMPLETED")
    status = state.normalise_empty(done, "source_rows", F.col("source_rows") * 100, F.lit(0), F.lit(None).cast("int"))
    return tables.select("user_id", "event_type", "source_rows", status.alias("status"))


# ------------------------------------------------------------------ diagnosis

# Per user and day a log: a view starts a phase, a purchase ends it, an error prints an exit line.
LOG = """
WITH l AS (SELECT user_id||'/'||strftime(ts, '%Y-%m-%d') AS unit, event_id AS n, event_type AS t, value AS v,
  CASE WHEN value < 20 THEN 'listing' WHEN value < 50 THEN 'scan' ELSE 'commit' END AS phase, user_id FROM events),
p AS (SELECT unit, phase, max(n) FILTER (t = 'view') AS s, count(*) FILTER (t = 'purchase') > 0 AS e FROM l GROUP BY ALL),
o AS (SELECT unit, max_by(phase, s) AS open_phase FROM p WHERE s IS NOT NULL AND NOT e GROUP BY 1),
f AS (SELECT unit, min_by(CASE WHEN v > 100 THEN 137 WHEN v > 30 THEN 1 ELSE 0 END, n) FILTER (t = 'error') AS copy_exit, max(n) FILTER (t = 'signup') AS app,
  max(CASE WHEN t = 'click' AND v > 90 THEN 1 ELSE 0 END) = 1 AS killed, max(CASE WHEN t = 'purchase' THEN 1 ELSE 0 END) = 1 AS ended, max(user_id) AS u FROM l GROUP BY 1),
x AS (SELECT *, CASE WHEN u < 50 THEN 0 WHEN u < 100 THEN 2 END AS exit_code FROM f LEFT JOIN o USING (unit))"""


def job_log(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    events = read(spark, d, "events")
    kind, value = F.col("event_type"), F.col("value")
    phase = F.when(value < 20, "listing").when(value < 50, "scan").otherwise("commit")
    exit_code = F.when(value > 100, "137").when(value > 30, "1").otherwise("0")
    line = (
        F.when(kind == "view", F.concat(F.lit("PHASE_START "), phase))
        .when(kind == "purchase", F.concat(F.lit("PHASE_END "), phase, F.lit(" seconds="), text(F.floor(value))))
        .when(kind == "error", F.concat(F.lit("DISTCP_EXIT_CODE="), exit_code))
        .when(kind == "signup", F.concat(F.lit("INFO submitted application_1700000000_"), text("event_id"), F.lit(" to queue")))
        .when(value > 90, F.lit("Container killed by the node manager")).otherwise(F.lit("noise = x")))
    unit = F.concat(text("user_id"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd"))
    lines = events.select(unit.alias("unit"), F.col("event_id").alias("line_no"), line.alias("line"))
    code = F.when(F.col("user_id") < 50, 0).when(F.col("user_id") < 100, 2)
    units = events.select(unit.alias("unit"), code.alias("exit_code")).distinct()
    return lines, units


@query(f"""{LOG}
SELECT unit, exit_code::BIGINT AS exit_code, copy_exit::BIGINT AS copy_exit_code,
  CASE WHEN open_phase IS NOT NULL THEN open_phase WHEN copy_exit <> 0 THEN 'distcp' WHEN exit_code <> 0 THEN 'script'
    WHEN exit_code IS NULL AND ended THEN 'after_script' WHEN exit_code IS NULL THEN 'ssh_or_startup' END AS failure_phase,
  app IS NOT NULL AS submitted, 'application_1700000000_'||app AS application_id, killed OR coalesce(copy_exit = 137, false) AS memory_kill_suspected FROM x""")
def failure_phase(spark, d):
    lines, units = job_log(spark, d)
    out = copyplan.diagnose(lines, units, "unit").drop("edge_host")
    for c in ("exit_code", "copy_exit_code"):
        out = out.withColumn(c, F.col(c).cast("bigint"))
    return out


@query(f"""{LOG}
SELECT unit, phase, max_by(floor(v), n) FILTER (t = 'purchase')::BIGINT AS seconds, count(*) FILTER (t = 'purchase') > 0 AS ended
FROM l WHERE t IN ('view', 'purchase') GROUP BY ALL""")
def phase_seconds(spark, d):
    lines, _ = job_log(spark, d)
    return copyplan.phase_times(lines, "unit").select("unit", "phase", "seconds", "ended")


@query("""
WITH m AS (SELECT user_id AS unit, event_id AS n, CASE event_type WHEN 'view' THEN 'BYTES_COPIED' WHEN 'click' THEN 'FILES_COPIED' END AS k, floor(value * 10)::BIGINT AS v FROM events)
SELECT unit, coalesce(max_by(v, n) FILTER (k = 'BYTES_COPIED'), 0)::BIGINT AS bytes_copied, coalesce(max_by(v, n) FILTER (k = 'FILES_COPIED'), 0)::BIGINT AS files_copied FROM m GROUP BY 1""")
def copy_metrics(spark, d):
    kind = F.col("event_type")
    number = text(F.floor(F.col("value") * 10))
    line = (F.when(kind == "view", F.concat(F.lit("BYTES_COPIED="), number))
            .when(kind == "click", F.concat(F.lit(" FILES_COPIED = "), number))
            .when(kind == "error", F.lit("BYTES_COPIED=oops")).otherwise(F.lit("hello")))
    lines = read(spark, d, "events").select(F.col("user_id").alias("unit"), F.col("event_id").alias("line_no"), line.alias("line"))
    return copyplan.copy_metrics(lines, "unit", ["BYTES_COPIED", "FILES_COPIED"])


@query("""
SELECT 'role '||event_type||'->u '||user_id||' (user)' AS object_name, 'role '||event_type AS role, 'u '||user_id AS principal, count(*)::BIGINT AS n FROM events GROUP BY ALL""")
def mapping_names(spark, d):
    name = mapping_name(F.concat(F.lit("role "), F.col("event_type")), F.concat(F.lit("u "), text("user_id")), F.lit("user"))
    counted = read(spark, d, "events").groupBy(name.alias("object_name")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("object_name", mapping_role("object_name").alias("role"),
                          mapping_principal("object_name").alias("principal"), "n")
