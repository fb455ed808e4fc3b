"""Choosing and comparing: partitions, counts, schemas, manifests and paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..operators import counting, lifecycle, locations, partitions, reconcile, schemas, tokens
from ..functions.types import comparable_type, hive_type_to_ddl, partition_transform
from ..session import materialize, scratch_path
from .base import month_spec, read, text

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn
    return add


# ------------------------------------------------------------------ partitions

LINE_MONTHS = "'year='||strftime(l_shipdate,'%Y')||'/month='||strftime(l_shipdate,'%m')"


def line_items(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as three tables (one per return flag) partitioned by ship year and month."""
    return read(spark, d, "lineitem").select(
        F.lit("sales").alias("db"), F.concat(F.lit("line_"), F.col("l_returnflag")).alias("tbl"),
        F.date_format("l_shipdate", "yyyy").alias("year"), F.date_format("l_shipdate", "MM").alias("month"),
        "l_quantity", "l_shipdate")


def line_partitions(spark: SparkSession, d: str) -> DataFrame:
    """The partition list, stored like a catalog's: else the filter would run on every row below the distinct."""
    specs = line_items(spark, d).select("db", "tbl", partitions.make_spec("year", "month").alias("spec")).distinct()
    return materialize(specs, "specs")


LINE_PARTS = f"SELECT DISTINCT 'sales' AS db, 'line_'||l_returnflag AS tbl, {LINE_MONTHS} AS spec FROM lineitem"


@query(f"SELECT {LINE_MONTHS} AS spec, count(*)::BIGINT AS row_count FROM lineitem GROUP BY 1")
def partition_counts(spark, d):
    return partitions.partition_counts(line_items(spark, d), ["year", "month"]).select("spec", "row_count")


@query(f"""
SELECT tbl, count(*)::BIGINT AS partition_count FROM ({LINE_PARTS}) GROUP BY 1""")
def nonempty_partitions(spark, d):
    return partitions.nonempty_partitions(line_items(spark, d), ["year", "month"], ["tbl"])


@query(f"""
SELECT db, tbl, spec FROM (
  SELECT *, row_number() OVER (PARTITION BY db, tbl ORDER BY spec DESC) AS rn FROM ({LINE_PARTS})
) WHERE rn <= 12""")
def partition_filter_last_n(spark, d):
    return partitions.select_partitions(line_partitions(spark, d), "last_n_partitions=12")


@query(f"""
SELECT db, tbl, spec FROM ({LINE_PARTS})
WHERE spec LIKE 'year=1996/%' OR regexp_matches(spec, '^year=.../month=.*$') OR regexp_matches(spec, '^year=199[0-9]/month=.2$')""")
def partition_filter_glob(spark, d):
    return partitions.select_partitions(line_partitions(spark, d), "year=1996/*, year=???/month=*, year=199?/month=?2")


ORDER_PARTS = """
SELECT DISTINCT 'sales' AS db, 'orders' AS tbl,
  'prio='||replace(o_orderpriority, ' ', '%20')||'/year='||strftime(o_orderdate,'%Y')||'/month='||strftime(o_orderdate,'%m') AS spec,
  o_orderpriority AS prio, strftime(o_orderdate,'%Y')::DOUBLE AS year, strftime(o_orderdate,'%m')::DOUBLE AS month
FROM orders"""


@query(f"""
SELECT db, tbl, spec FROM ({ORDER_PARTS})
WHERE (year >= 1998 AND month < 4) OR month = 12 OR (year = 1996 AND month = 7)
   OR (prio = '4-NOT SPECIFIED' AND year != 1997) OR (prio > '4' AND prio <= '5-LOW' AND year <= 1996.5)""")
def partition_filter_predicate(spark, d):
    orders = read(spark, d, "orders")
    found = orders.select(
        F.lit("sales").alias("db"), F.lit("orders").alias("tbl"),
        F.concat(F.lit("prio="), F.replace("o_orderpriority", F.lit(" "), F.lit("%20")), F.lit("/"),
                 month_spec("o_orderdate")).alias("spec")).distinct()
    found = materialize(found, "specs")
    wanted = ("year>=1998 AND month<4 OR month=12, year=1996/month=7, prio='4-NOT SPECIFIED' AND year!=1997, "
              "prio>'4' AND prio<=5-LOW AND year<=1996.5")
    return partitions.select_partitions(found, wanted)


@query(f"""
WITH chosen AS (SELECT tbl, spec FROM (
    SELECT *, row_number() OVER (PARTITION BY tbl ORDER BY spec DESC) AS rn FROM ({LINE_PARTS}))
  WHERE rn <= 6 OR spec LIKE 'year=1996/%'),
lines AS (SELECT 'line_'||l_returnflag AS tbl, {LINE_MONTHS} AS spec FROM lineitem)
SELECT t.table_name, count(c.spec)::BIGINT AS row_count
FROM (VALUES ('line_A'), ('line_N'), ('line_R'), ('line_none')) t(table_name)
LEFT JOIN lines l ON l.tbl = t.table_name LEFT JOIN chosen c ON c.tbl = l.tbl AND c.spec = l.spec GROUP BY 1""")
def partition_scoped_count(spark, d):
    """Three partitioned Parquet trees and one without any file, counted within their selected partitions by one scan."""
    path = scratch_path(spark, "lines")
    lines = line_items(spark, d)
    lifecycle.write_partitioned(lines.select("tbl", "year", "month", "l_quantity"), path, ["tbl", "year", "month"])
    chosen = partitions.select_partitions(line_partitions(spark, d), "last_n_partitions=6, year=1996/*")
    names = ("line_A", "line_N", "line_R", "line_none")
    tables = spark.createDataFrame([(n, f"{path}/tbl={n}", "parquet") for n in names], "table_name string, location string, format string")
    return counting.count_selected(spark, tables, chosen.select(F.col("tbl").alias("table_name"), "spec"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*)::BIGINT AS row_count FROM {t}" for t in TABLES))
def table_row_counts(spark, d):
    """All sample tables by one scan."""
    tables = spark.createDataFrame([(t, f"{d}/{t}.parquet", "parquet") for t in TABLES], "table_name string, location string, format string")
    return counting.count_locations(spark, tables)


REGISTERED = """
SELECT DISTINCT 'sales' AS db, l_linestatus AS tbl, 'year='||strftime(l_shipdate,'%Y')||'/month='||
  CASE WHEN year(l_shipdate) < 1997 THEN month(l_shipdate)::VARCHAR ELSE strftime(l_shipdate,'%m') END AS spec FROM lineitem"""
ACTUAL = """
SELECT DISTINCT 'sales' AS db, o_orderstatus AS tbl,
  'year='||strftime(o_orderdate,'%Y')||'/month='||strftime(o_orderdate,'%m') AS spec FROM orders"""


@query(f"""
WITH r AS ({REGISTERED}), a AS ({ACTUAL}),
j AS (SELECT coalesce(r.db, a.db) AS db, coalesce(r.tbl, a.tbl) AS tbl, coalesce(r.spec, a.spec) AS spec,
        r.spec IS NOT NULL AS in_r, a.spec IS NOT NULL AS in_a,
        regexp_replace(coalesce(r.spec, a.spec), '=0+([0-9])', '=\\1', 'g') AS bare
      FROM r FULL JOIN a ON r.db = a.db AND r.tbl = a.tbl AND r.spec = a.spec)
SELECT j.db, j.tbl, j.spec,
  CASE WHEN j.in_r AND j.in_a THEN 'MATCH' WHEN o.spec IS NOT NULL THEN 'PADDING'
       WHEN j.in_r THEN 'EMPTY' ELSE 'UNREGISTERED' END AS state, o.spec AS padded_as
FROM j LEFT JOIN j o ON o.db = j.db AND o.tbl = j.tbl AND o.bare = j.bare AND o.in_r <> j.in_r AND o.in_a <> j.in_a
  AND NOT (j.in_r AND j.in_a)""")
def registered_vs_actual(spark, d):
    lines = read(spark, d, "lineitem")
    plain = F.month("l_shipdate").cast("string")
    month = F.when(F.year("l_shipdate") < 1997, plain).otherwise(F.date_format("l_shipdate", "MM"))
    registered = lines.select(
        F.lit("sales").alias("db"), F.col("l_linestatus").alias("tbl"),
        F.concat(F.lit("year="), F.date_format("l_shipdate", "yyyy"), F.lit("/month="), month).alias("spec"))
    actual = read(spark, d, "orders").select(
        F.lit("sales").alias("db"), F.col("o_orderstatus").alias("tbl"), month_spec("o_orderdate").alias("spec"))
    return partitions.compare_partitions(registered, actual)


# ------------------------------------------------------------------ reconciliation

# The altered copy: one month gone, and the largest quantities of 1996 gone, except for one flag.
DROPPED = """((strftime(l_shipdate,'%Y-%m') = '1995-02' AND l_returnflag = 'A')
 OR (year(l_shipdate) = 1996 AND l_quantity >= 49 AND l_returnflag <> 'N'))"""


def altered_copy(lines: DataFrame) -> DataFrame:
    month_gone = (F.date_format("l_shipdate", "yyyy-MM") == "1995-02") & (F.col("tbl") == "line_A")
    big_gone = (F.year("l_shipdate") == 1996) & (F.col("l_quantity") >= 49) & (F.col("tbl") != "line_N")
    return lines.where(~(month_gone | big_gone))


COMPARED = f"""
WITH s AS (SELECT 'line_'||l_returnflag AS tbl, {LINE_MONTHS} AS spec, count(*) AS n FROM lineitem GROUP BY ALL),
t AS (SELECT 'line_'||l_returnflag AS tbl, {LINE_MONTHS} AS spec, count(*) AS n FROM lineitem WHERE NOT {DROPPED} GROUP BY ALL),
j AS (SELECT coalesce(s.tbl, t.tbl) AS tbl, coalesce(s.spec, t.spec) AS spec, coalesce(s.n, 0) AS a, coalesce(t.n, 0) AS b,
        s.n IS NOT NULL AS ina, t.n IS NOT NULL AS inb FROM s FULL JOIN t ON s.tbl = t.tbl AND s.spec = t.spec)"""


@query(f"""{COMPARED}
SELECT tbl, spec, a::BIGINT AS source_rows, b::BIGINT AS dest_rows, CASE WHEN a = b THEN 'MATCH' WHEN NOT inb THEN 'MISSING' ELSE 'DIFFERS' END AS state FROM j""")
def reconcile_months(spark, d):
    lines = line_items(spark, d)
    both = reconcile.compare_counts(
        partitions.partition_counts(lines, ["year", "month"], ["tbl"]),
        partitions.partition_counts(altered_copy(lines), ["year", "month"], ["tbl"]), ["tbl", "spec"])
    state = (F.when(F.col("source_rows") == F.col("dest_rows"), "MATCH").when(~F.col("in_dest"), "MISSING")
             .otherwise("DIFFERS"))
    return both.select("tbl", "spec", "source_rows", "dest_rows", state.alias("state"))


@query(f"""{COMPARED},
v AS (SELECT tbl, sum(a)::BIGINT AS source_rows, sum(b)::BIGINT AS dest_rows, count(*) FILTER (ina)::BIGINT AS source_partitions,
  count(*) FILTER (inb)::BIGINT AS dest_partitions, count(*) FILTER (a <> b)::BIGINT AS differing_partitions FROM j GROUP BY 1)
SELECT *, source_rows = dest_rows AS row_count_match, source_partitions = dest_partitions AS partition_count_match,
  CASE WHEN source_rows = dest_rows AND source_partitions = dest_partitions THEN 'VALIDATED' ELSE 'VALIDATED_WITH_WARNINGS' END AS status,
  nullif(concat_ws('; ', CASE WHEN source_rows <> dest_rows THEN 'Row count mismatch: source='||source_rows||', dest='||dest_rows END,
   CASE WHEN source_partitions <> dest_partitions THEN 'Partition count mismatch: source='||source_partitions||', dest='||dest_partitions END), '') AS error_message
FROM v""")
def reconcile_rows(spark, d):
    lines = line_items(spark, d)
    out = reconcile.reconcile(
        partitions.partition_counts(lines, ["year", "month"], ["tbl"]),
        partitions.partition_counts(altered_copy(lines), ["year", "month"], ["tbl"]), ["tbl"], ["spec"])
    return out.drop("schema_match", "partition_schema_match")


CATALOG = """
WITH p AS (SELECT p_brand AS db, p_type AS tbl, replace(p_name,' ','_') AS name, min(p_size) AS size FROM part GROUP BY ALL),
src AS (SELECT db, tbl, name, size AS pos, CASE WHEN size < 10 THEN 'varchar('||size||')' WHEN size < 20 THEN 'tinyint'
   WHEN size < 30 THEN 'decimal(18,'||(size-20)||')' WHEN size < 40 THEN 'struct<a:smallint,b:char('||size||')>' ELSE 'bigint' END AS type FROM p),
raw AS (SELECT db, tbl, upper(name) AS name, size AS pos, CASE WHEN size < 10 THEN 'string' WHEN size < 20 THEN 'int'
   WHEN size < 25 THEN 'decimal(18,'||(size-20)||')' WHEN size < 30 THEN 'decimal(20,'||(size-20)||')'
   WHEN size < 40 THEN 'struct<a:int,b:string>' WHEN size < 48 THEN 'bigint' ELSE 'string' END AS type FROM p),
dst AS (SELECT * FROM raw WHERE NOT starts_with(name, 'OLD') UNION ALL
        SELECT db, tbl, name||'_NEW', pos, type FROM raw WHERE starts_with(name, 'HOT')),
norm AS (SELECT *, lower(name) AS col, regexp_replace(regexp_replace(type, '(varchar|char)[(][0-9]+[)]', 'string', 'g'), '(tinyint|smallint)', 'int', 'g') AS form FROM src)"""


def catalogs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """part as a column catalog (database = brand, table = type, column = name) and an altered one."""
    size, s = F.col("size"), text("size")
    cols = read(spark, d, "part").groupBy(
        F.col("p_brand").alias("db"), F.col("p_type").alias("tbl"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("name")).agg(F.min("p_size").alias("size"))
    scale = text(size - 20)
    src_type = (
        F.when(size < 10, F.concat(F.lit("varchar("), s, F.lit(")"))).when(size < 20, F.lit("tinyint"))
        .when(size < 30, F.concat(F.lit("decimal(18,"), scale, F.lit(")")))
        .when(size < 40, F.concat(F.lit("struct<a:smallint,b:char("), s, F.lit(")>"))).otherwise(F.lit("bigint")))
    dst_type = (
        F.when(size < 10, F.lit("string")).when(size < 20, F.lit("int"))
        .when(size < 25, F.concat(F.lit("decimal(18,"), scale, F.lit(")")))
        .when(size < 30, F.concat(F.lit("decimal(20,"), scale, F.lit(")")))
        .when(size < 40, F.lit("struct<a:int,b:string>")).when(size < 48, F.lit("bigint")).otherwise(F.lit("string")))
    src = cols.select("db", "tbl", "name", size.alias("pos"), src_type.alias("type"))
    raw = cols.select("db", "tbl", F.upper("name").alias("name"), size.alias("pos"), dst_type.alias("type"))
    added = raw.where(F.col("name").startswith("HOT")).withColumn("name", F.concat("name", F.lit("_NEW")))
    return src, raw.where(~F.col("name").startswith("OLD")).unionByName(added)


@query(f"""{CATALOG},
j AS (SELECT coalesce(s.db, t.db) AS db, coalesce(s.tbl, t.tbl) AS tbl, coalesce(s.col, lower(t.name)) AS col,
  CASE WHEN s.pos IS NULL THEN 1000000 + t.pos ELSE s.pos END AS pos,
  CASE WHEN t.name IS NULL THEN 'Missing column: '||s.col WHEN s.col IS NULL THEN 'Extra column in dest: '||lower(t.name)
       WHEN s.form <> t.type THEN 'Type mismatch for '||s.col||': '||s.type||' vs '||t.type END AS message
  FROM norm s FULL JOIN dst t ON s.db = t.db AND s.tbl = t.tbl AND s.col = lower(t.name))
SELECT db, tbl, count(message) = 0 AS schema_match, count(message)::BIGINT AS difference_count,
  coalesce(string_agg(message, '; ' ORDER BY pos, col) FILTER (message IS NOT NULL), '') AS differences FROM j GROUP BY db, tbl""")
def reconcile_schema(spark, d):
    src, dst = catalogs(spark, d)
    out = schemas.compare_schemas(src, dst, normalise=True)
    return out.select("db", "tbl", "schema_match", F.col("difference_count").cast("bigint").alias("difference_count"),
                      "differences")


@query(f"""{CATALOG},
k AS (SELECT * FROM src WHERE pos >= 20), l AS (SELECT * FROM dst WHERE pos >= 20),
j AS (SELECT coalesce(s.db, t.db) AS db, coalesce(s.tbl, t.tbl) AS tbl, coalesce(lower(s.name), lower(t.name)) AS col,
  CASE WHEN s.pos IS NULL THEN 1000000 + t.pos ELSE s.pos END AS pos,
  CASE WHEN t.name IS NULL THEN 'Missing partition column: '||lower(s.name) WHEN s.name IS NULL THEN 'Extra partition column in dest: '||lower(t.name)
       WHEN s.type <> t.type THEN 'Partition type mismatch for '||lower(s.name)||': '||s.type||' vs '||t.type END AS message
  FROM k s FULL JOIN l t ON s.db = t.db AND s.tbl = t.tbl AND lower(s.name) = lower(t.name)
  WHERE (coalesce(s.db, t.db), coalesce(s.tbl, t.tbl)) IN (SELECT (db, tbl) FROM k))
SELECT a.db, a.tbl, count(message) = 0 AS schema_match,
  coalesce(string_agg(message, '; ' ORDER BY pos, col) FILTER (message IS NOT NULL), '') AS differences
FROM (SELECT db, tbl FROM k UNION SELECT db, tbl FROM l) a LEFT JOIN j USING (db, tbl) GROUP BY a.db, a.tbl""")
def reconcile_partition_columns(spark, d):
    src, dst = (c.withColumn("is_partition", F.col("pos") >= 20) for c in catalogs(spark, d))
    out = schemas.compare_partition_columns(src, dst)
    return out.select("db", "tbl", "schema_match", "differences")


@query(f"""{CATALOG}
SELECT db, tbl, name, regexp_replace(type, '([a-z]):([a-z])', '\\1 \\2', 'g') AS ddl, form,
  regexp_extract(type, '^[^(<]*') AS head, regexp_extract(type, '^decimal[(]18,([0-9]+)[)]$', 1) AS scale,
  p_param AS bucket_param FROM (SELECT *, CASE WHEN pos < 10 THEN pos END AS p_param FROM norm)""")
def type_texts(spark, d):
    src, _ = catalogs(spark, d)
    bucket = F.when(F.col("pos") < 10, F.concat(F.lit("bucket["), text("pos"), F.lit("]"))).otherwise(F.lit("identity"))
    return src.select(
        "db", "tbl", "name", hive_type_to_ddl("type").alias("ddl"), comparable_type("type").alias("form"),
        F.regexp_extract("type", "^[^(<]*", 0).alias("head"),
        F.regexp_extract("type", r"^decimal\(18,(\d+)\)$", 1).alias("scale"),
        partition_transform(bucket)["param"].alias("bucket_param"))


@query(f"""{COMPARED.replace("'line_'||l_returnflag", "'sup_'||l_suppkey")},
v AS (SELECT tbl, sum(a) AS sr, sum(b) AS dr, count(*) FILTER (ina) AS sp, count(*) FILTER (inb) AS dp FROM j GROUP BY 1)
SELECT count(*)::BIGINT AS total, count(*) FILTER (sr = dr AND sp = dp)::BIGINT AS passed, count(*) FILTER (sr <> dr OR sp <> dp)::BIGINT AS failed,
  count(*) FILTER (sr <> dr)::BIGINT AS row_count_mismatches, count(*) FILTER (sp <> dp)::BIGINT AS partition_count_mismatches,
  0::BIGINT AS schema_mismatches FROM v""")
def validation_summary(spark, d):
    keyed = read(spark, d, "lineitem").select(
        F.concat(F.lit("line_"), F.col("l_returnflag")).alias("tbl"), F.concat(F.lit("sup_"), text("l_suppkey")).alias("sup"),
        F.date_format("l_shipdate", "yyyy").alias("year"), F.date_format("l_shipdate", "MM").alias("month"),
        "l_quantity", "l_shipdate")
    checked = reconcile.reconcile(
        partitions.partition_counts(keyed, ["year", "month"], ["sup"]),
        partitions.partition_counts(altered_copy(keyed), ["year", "month"], ["sup"]), ["sup"], ["spec"])
    return reconcile.validation_summary(checked)


# ------------------------------------------------------------------ manifests and tokens

INCLUDE = (("Brand#1", "red_*"), ("Brand#1", "*_BOLT_*"), ("Brand#2", "*"), ("Brand#3", "small_r?ng_*"),
           ("Brand#4", "no_such_table"), ("Brand#5", "*9"), ("Brand#6", "?o*"), ("Brand#7", "*e*"),
           ("NoBrand", "x"), ("NoBrand", "y*"))
EXCLUDE = (("Brand#1", "red_ring*"), ("Brand#2", "*gear*"), ("Brand#2", "old_*"), ("Brand#4", "no_such_t*"),
           ("Brand#5", "hot_*"))


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)


PART_TABLES = "SELECT p_brand AS db, replace(p_name,' ','_')||'_'||p_partkey AS tbl, p_size FROM part"
GLOB = "'^'||replace(replace(lower({0}), '*', '.*'), '?', '.')||'$'"


def part_tables(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), text("p_partkey"))
    return read(spark, d, "part").select(F.col("p_brand").alias("db"), name.alias("tbl"), "p_size")


def part_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The globs above, and each brand's tables of size 50 (and their unknown twins) by name."""
    fixed = spark.createDataFrame([(b, "include", t) for b, t in INCLUDE] + [(b, "exclude", t) for b, t in EXCLUDE],
                                  "db string, role string, token string")
    named = part_tables(spark, d).where(F.col("p_size") == 50)
    twins = named.select("db", F.lit("include").alias("role"), F.explode(F.array(
        F.upper("tbl"), F.concat("tbl", F.lit("_gone")))).alias("token"))
    return fixed.unionByName(twins)


@query(f"""
WITH c AS ({PART_TABLES}), inc AS (SELECT * FROM ({_values(INCLUDE)}) t(db, token)
  UNION ALL SELECT db, upper(tbl) FROM c WHERE p_size = 50 UNION ALL SELECT db, tbl||'_gone' FROM c WHERE p_size = 50),
exc AS (SELECT * FROM ({_values(EXCLUDE)}) t(db, token)),
hit AS (SELECT DISTINCT c.db, c.tbl FROM c JOIN inc i ON i.db = c.db AND regexp_matches(lower(c.tbl), {GLOB.format('i.token')})),
miss AS (SELECT DISTINCT i.db, i.token, CASE WHEN i.db NOT IN (SELECT db FROM c) THEN 'DATABASE_NOT_FOUND' ELSE 'TABLE_NOT_FOUND' END AS outcome FROM inc i
  WHERE i.db NOT IN (SELECT db FROM c) OR (NOT regexp_matches(i.token, '[*?]')
    AND NOT EXISTS (SELECT 1 FROM c WHERE c.db = i.db AND lower(c.tbl) = lower(i.token))
    AND NOT EXISTS (SELECT 1 FROM exc e WHERE e.db = i.db AND regexp_matches(lower(i.token), {GLOB.format('e.token')}))))
SELECT db, tbl AS name, 'FOUND' AS outcome FROM hit h
WHERE NOT EXISTS (SELECT 1 FROM exc e WHERE e.db = h.db AND regexp_matches(lower(h.tbl), {GLOB.format('e.token')}))
UNION ALL SELECT db, token, outcome FROM miss""")
def resolve_tokens(spark, d):
    resolved, missing = tokens.resolve_tables(part_manifest(spark, d), part_tables(spark, d))
    return resolved.select("db", F.col("tbl").alias("name"), F.lit("FOUND").alias("outcome")).unionByName(
        missing.select("db", F.col("token").alias("name"), F.col("error_type").alias("outcome")))


LEFTOVERS = """SELECT p_brand AS db, replace(p_name,' ','_')||'_'||p_partkey||
  CASE p_size WHEN 7 THEN '_BACKUP_' WHEN 8 THEN '__BACKUP__' WHEN 9 THEN '__ice_staging' ELSE '' END AS tbl FROM part"""


@query(f"""
WITH c AS ({LEFTOVERS}), exc AS (SELECT * FROM ({_values(EXCLUDE)}) t(db, token))
SELECT db, tbl, regexp_matches(lower(tbl), '(_backup_|__backup__|__ice_staging)$') AS leftover,
  CASE WHEN lower(tbl) LIKE '%__backup__' ESCAPE '!' AND regexp_matches(tbl, '__BACKUP__$') THEN regexp_replace(tbl, '__BACKUP__$', '')
       ELSE regexp_replace(tbl, '_BACKUP_$', '') END AS base
FROM c WHERE NOT EXISTS (SELECT 1 FROM exc e WHERE e.db = c.db AND regexp_matches(lower(c.tbl), {GLOB.format('e.token')}))""")
def exclude_tokens(spark, d):
    ending = (F.when(F.col("p_size") == 7, "_BACKUP_").when(F.col("p_size") == 8, "__BACKUP__")
              .when(F.col("p_size") == 9, "__ice_staging").otherwise(""))
    catalog = part_tables(spark, d).select("db", F.concat("tbl", ending).alias("tbl"))
    exclude = spark.createDataFrame(list(EXCLUDE), "db string, token string")
    dropped = tokens.match_tokens(exclude, catalog).select("db", "tbl").distinct()
    return catalog.join(dropped, ["db", "tbl"], "left_anti").select(
        "db", "tbl", tokens.is_leftover("tbl").alias("leftover"), tokens.without_leftover_ending("tbl").alias("base"))


def customer_sheet(spark: SparkSession, d: str) -> DataFrame:
    """customer as table-copy sheet rows, with the blanks and odd words that sheets have."""
    nation, low = F.col("c_nationkey"), F.col("c_acctbal") < 0
    cell = (
        F.when(nation == 7, F.lit("nan")).when(nation == 3, F.lit("Exclude: t_1, t_9"))
        .when((nation == 5) & (F.col("c_mktsegment") == "BUILDING"), F.lit("*"))
        .otherwise(F.concat(F.lit(" t_"), text(nation), F.lit(" ,, t_"), text(nation + 1))))
    return read(spark, d, "customer").select(
        F.col("c_custkey").alias("row_index"),
        F.when(F.col("c_acctbal") > 9900, F.lit("  ")).otherwise(F.col("c_mktsegment")).alias("database"),
        cell.alias("table"),
        F.when(low, F.lit("None")).otherwise(F.concat(F.lit("dw_"), F.col("c_mktsegment"))).alias("dest_database"),
        F.when(nation < 5, F.concat(F.lit("s3://b"), text(nation))).when(nation < 9, F.lit("s3n://c"))
        .when(nation < 12, F.lit(" ")).otherwise(F.lit("plain")).alias("bucket"),
        F.when(nation > 20, F.lit("year>=2020")).otherwise(F.lit(None).cast("string")).alias("partition_filter"),
        F.lit(None).cast("string").alias("endpoint"))


@query("""
WITH r AS (SELECT c_custkey AS i, c_mktsegment AS src_db,
  CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE 'dw_'||c_mktsegment END AS dest_db,
  CASE WHEN c_nationkey < 5 THEN 's3a://b'||c_nationkey WHEN c_nationkey < 9 THEN 's3a://c' WHEN c_nationkey < 12 THEN 's3a://default' ELSE 's3a://plain' END AS bucket,
  CASE WHEN c_nationkey > 20 THEN 'year>=2020' ELSE '' END AS pf,
  CASE WHEN c_nationkey = 3 THEN 'exclude' ELSE 'include' END AS role,
  CASE WHEN c_nationkey = 7 THEN ['*'] WHEN c_nationkey = 3 THEN ['t_1', 't_9'] WHEN c_nationkey = 5 AND c_mktsegment = 'BUILDING' THEN ['*']
       ELSE ['t_'||c_nationkey, '', 't_'||(c_nationkey+1)] END AS toks
  FROM customer WHERE NOT c_acctbal > 9900),
e AS (SELECT * EXCLUDE toks, unnest(toks) AS token, generate_subscripts(toks, 1) - 1 AS pos FROM r),
f AS (SELECT src_db, dest_db, bucket, pf, role, token, min((i, pos)) AS first FROM e WHERE token <> '' GROUP BY ALL),
g AS (SELECT src_db, dest_db, bucket, pf, max(role = 'include' AND token = '*') AS star, max(role = 'include') AS named, min(first) AS first FROM f GROUP BY ALL),
o AS (SELECT f.* FROM f JOIN g USING (src_db, dest_db, bucket, pf) WHERE role = 'include' AND NOT star
  UNION ALL SELECT src_db, dest_db, bucket, pf, 'include', '*', first FROM g WHERE star OR NOT named
  UNION ALL SELECT * FROM f WHERE role = 'exclude')
SELECT src_db, dest_db, bucket, '' AS endpoint, pf AS partition_filter, role, token, first[1]::BIGINT AS first_row, first[2]::BIGINT AS first_pos FROM o""")
def group_manifest(spark, d):
    out = tokens.group_manifest(tokens.normalise_manifest(customer_sheet(spark, d), "s3a://default"))
    return out.withColumn("first_pos", F.col("first_pos").cast("bigint"))


@query("""
WITH r AS (SELECT c_custkey AS row_index, CASE WHEN c_acctbal > 9900 THEN NULL ELSE c_mktsegment END AS db,
  CASE WHEN c_nationkey = 4 THEN 'bad-name' WHEN c_nationkey = 6 THEN NULL ELSE 'T'||c_nationkey END AS tbl,
  CASE WHEN c_nationkey = 8 THEN 's3://b/it''s' ELSE 's3://b/'||c_custkey||'/' END AS loc FROM customer),
j AS (SELECT *, CASE WHEN db IS NULL OR tbl IS NULL THEN 'missing required cell' WHEN NOT regexp_matches(tbl, '^[A-Za-z0-9_]+$') THEN 'invalid identifier'
  WHEN contains(loc, '''') THEN 'location contains a quote' END AS reason FROM r),
n AS (SELECT *, CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY reason IS NULL, lower(db), lower(tbl) ORDER BY row_index) > 1 THEN 'duplicate table' ELSE reason END AS why FROM j)
SELECT row_index, db AS database, tbl AS "table", CASE WHEN why IS NULL THEN 's3a://b/'||row_index ELSE loc END AS s3_location, coalesce(why, 'VALID') AS outcome FROM n""")
def registration_rows(spark, d):
    nation = F.col("c_nationkey")
    sheet = read(spark, d, "customer").select(
        F.col("c_custkey").alias("row_index"),
        F.when(F.col("c_acctbal") > 9900, F.lit("null")).otherwise(F.col("c_mktsegment")).alias("database"),
        F.when(nation == 4, F.lit("bad-name")).when(nation == 6, F.lit("")).otherwise(F.concat(F.lit("T"), text(nation))).alias("table"),
        F.when(nation == 8, F.lit("s3://b/it's")).otherwise(
            F.concat(F.lit(" s3://b/"), text("c_custkey"), F.lit("/"))).alias("s3_location"))
    valid, rejected = tokens.registration_rows(sheet)
    return valid.withColumn("outcome", F.lit("VALID")).unionByName(rejected.withColumnRenamed("reason", "outcome"))


# ------------------------------------------------------------------ paths

HOST = "regexp_extract(url, '^[a-z]+://([^/]*)', 1)"
CLEAN = "regexp_extract(url, '^([^?#]*)', 1)"


def page_urls(spark: SparkSession, d: str) -> DataFrame:
    pages = read(spark, d, "pages")
    return pages.select(
        "page_id", "url", F.regexp_extract("url", "^([^?#]*)", 1).alias("clean"),
        F.regexp_extract("url", "^[a-z]+://([^/]*)", 1).alias("host"),
        F.regexp_extract("url", "^[a-z]+://[^/]*/([^/?#]*)", 1).alias("lang"),
        F.length("html").cast("bigint").alias("size"))


@query(f"""
WITH u AS (SELECT page_id, rtrim('s3a://bkt/'||regexp_extract(url, '^[a-z]+://([^?#]*)', 1), '/') AS dest,
    's3a://bkt/'||regexp_extract(url, '^[a-z]+://([^/]*/[^/?#]*)', 1) AS folder FROM pages),
o AS (SELECT 'page' AS kind, page_id::VARCHAR AS name, dest FROM u UNION
      SELECT DISTINCT 'folder', folder, rtrim(folder, '/') FROM u),
j AS (SELECT a.kind, a.name, a.dest,
  (SELECT count(*) FROM o b WHERE b.dest = a.dest) - 1 AS same,
  (SELECT count(*) FROM o b WHERE starts_with(a.dest, b.dest||'/')) AS above,
  (SELECT count(*) FROM o b WHERE starts_with(b.dest, a.dest||'/')) AS below,
  (SELECT max(b.dest) FROM o b WHERE starts_with(a.dest, b.dest||'/')) AS nearest_above FROM o a)
SELECT kind, name, dest, same::BIGINT AS same, above::BIGINT AS above, below::BIGINT AS below, nearest_above,
  'Destination '||dest||' overlaps: '||same||' at the same path, '||above||' above, '||below||' below' AS message
FROM j WHERE same + above + below > 0""")
def destination_overlap(spark, d):
    urls = page_urls(spark, d)
    bare = F.regexp_replace("clean", "^[a-z]+://", "s3a://bkt/")
    pages = urls.select(F.lit("page").alias("kind"), text("page_id").alias("name"), bare.alias("dest"))
    folder = F.concat(F.lit("s3a://bkt/"), F.col("host"), F.lit("/"), F.col("lang"))
    folders = urls.select(F.lit("folder").alias("kind"), folder.alias("name"), folder.alias("dest")).distinct()
    return locations.overlaps(pages.unionByName(folders), ["kind", "name"])


INSIDE = f"""
SELECT {HOST} AS host, page_id, rtrim({CLEAN}, '/') AS loc, 'https://'||{HOST}||'/en' AS root, length(html) AS n FROM pages"""


@query(f"""
WITH p AS (SELECT *, starts_with(loc, root||'/') OR loc = root AS inside FROM ({INSIDE}))
SELECT host, count(*)::BIGINT AS total_partitions, count(*) FILTER (NOT inside)::BIGINT AS outside_partitions,
  (count(*) FILTER (NOT inside))::BIGINT AS total_files, coalesce(sum(n) FILTER (NOT inside), 0)::BIGINT AS total_bytes,
  sum(CASE WHEN n > 1000 THEN n END) FILTER (NOT inside)::BIGINT AS total_rows FROM p GROUP BY 1""")
def out_of_root(spark, d):
    urls = page_urls(spark, d).select(
        "host", "page_id", F.col("clean").alias("location"), F.lit(1).cast("bigint").alias("file_count"),
        F.col("size").alias("size_bytes"), F.when(F.col("size") > 1000, F.col("size")).alias("row_count"))
    roots = urls.select("host").distinct().withColumn("root", F.concat(F.lit("HTTPS://"), "host", F.lit("//en/")))
    totals = urls.groupBy("host").agg(F.count(F.lit(1)).alias("total_partitions"))
    return locations.outside_summary(locations.outside_root(urls, roots, ["host"]), totals, ["host"])


@query(f"""
WITH p AS (SELECT page_id, '/'||trim(regexp_extract(url, '^[a-z]+://[^/]*/(.*)$', 1), '/') AS path, regexp_extract(url, '^[a-z]+://[^/]*/([^/?#]*)', 1) AS lang FROM pages),
x AS (SELECT '/en' AS prefix UNION SELECT '/e' UNION SELECT '/de/10' UNION SELECT DISTINCT '/'||lang FROM p WHERE lang > 'en'
      UNION SELECT DISTINCT regexp_extract(path, '^(/[a-z]+/[0-9]+)', 1) FROM p WHERE path LIKE '%#top'),
m AS (SELECT page_id, path, (SELECT max_by(prefix, length(prefix)) FROM x WHERE prefix <> '' AND (p.path = prefix OR starts_with(p.path, prefix||'/'))) AS matched_prefix FROM p)
SELECT page_id, matched_prefix, nullif(trim(substr(path, length(coalesce(matched_prefix, '')) + 1), '/'), '') AS relative FROM m""")
def longest_prefix(spark, d):
    urls = page_urls(spark, d)
    fixed = spark.createDataFrame([("hdfs://nn:8020//en/",), ("/e",), ("/de/10",)], "prefix string")
    langs = urls.where(F.col("lang") > "en").select(F.concat(F.lit("/"), "lang").alias("prefix"))
    tops = urls.where(F.col("url").endswith("#top")).select(
        F.regexp_extract("url", "^[a-z]+://[^/]*(/[a-z]+/[0-9]+)", 1).alias("prefix"))
    out = locations.strip_longest_prefix(urls.select("page_id", "url"), fixed.union(langs).union(tops), "url")
    return out.select("page_id", "matched_prefix", "relative")


@query(f"""
WITH p AS (SELECT page_id, {HOST} AS host, regexp_extract(url, '^[a-z]+://[^/]*/([^/?#]*)', 1) AS lang, {CLEAN} AS u FROM pages),
q AS (SELECT *, CASE lang WHEN 'en' THEN 's3' WHEN 'fr' THEN 's3n' WHEN 'de' THEN 'S3A' ELSE 'maprfs' END AS scheme, substr(u, strpos(u, '://') + 3) AS body FROM p)
SELECT page_id,
  CASE WHEN scheme IN ('s3', 's3n') THEN 's3a://'||body ELSE 's3a://'||scheme||'://'||body END AS uri,
  CASE WHEN trim(substr(body, strpos(body, '/')), '/') = '' THEN '' ELSE '/'||trim(substr(body, strpos(body, '/')), '/') END AS plain,
  CASE WHEN scheme = 's3' THEN 's3a://new'||substr(body, length(host) + 1) END AS rebased,
  CASE WHEN scheme = 's3' THEN NULL ELSE scheme||'://'||body||' is not under s3://'||host END AS problem,
  CASE WHEN scheme = 's3n' THEN 's3a://dst/'||ltrim(substr(body, length(host) + 1), '/') ELSE 's3a://bkt/db/'||lang END AS dest,
  CASE WHEN scheme IN ('s3', 's3n', 'S3A') THEN 's3a://'||rtrim(body, '/')||'_iceberg' END AS sibling,
  CASE WHEN lang = 'en' THEN 's3a://b' ELSE 's3a://b/en' END AS dest_bucket,
  CASE WHEN lang = 'en' THEN 'en' WHEN lang = 'fr' THEN 'x/y' ELSE regexp_extract(rtrim(body, '/'), '([^/]*)$', 1) END AS dest_folder
FROM q""")
def rebase_paths(spark, d):
    lang = F.col("lang")
    scheme = F.when(lang == "en", "s3").when(lang == "fr", "s3n").when(lang == "de", "S3A").otherwise("maprfs")
    rows = page_urls(spark, d).withColumn("loc", F.concat(scheme, F.regexp_replace("clean", "^[a-z]+", "")))
    prefix = F.concat(F.lit("s3://"), F.col("host"), F.lit("/"))
    folder = F.when(lang == "en", F.lit("/en/")).when(lang == "fr", F.lit("x//y/"))
    target = paths.folder_target("loc", F.lit("s3: b//en/"), folder)
    return rows.select(
        "page_id",
        paths.object_store_uri("loc").alias("uri"),
        paths.plain_path("loc").alias("plain"),
        paths.rebase("loc", prefix, F.lit("s3a://new/")).alias("rebased"),
        paths.rebase_problem("loc", prefix).alias("problem"),
        paths.destination_path("loc", F.lit("db"), lang, F.lit("s3a://bkt/"), F.concat(F.lit("s3n://"), F.col("host")),
                               F.lit("s3a://dst/")).alias("dest"),
        paths.sibling_target("loc").alias("sibling"),
        target["dest_bucket"].alias("dest_bucket"), target["dest_folder"].alias("dest_folder"))
