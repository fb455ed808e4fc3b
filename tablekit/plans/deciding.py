"""Decision tables and table lifecycles over the sample tables, every outcome reached."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import errors
from ..operators import lifecycle, partitions, reconcile, schemas, state
from ..session import scratch_path
from ..sources import datasets
from .base import read

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn
    return add


def picked(key: str, values: list[str | None], step: int = 1):
    """One of the values by the key's remainder, after division by ``step``."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]),
                 (F.floor(F.col(key) / step) % len(values)).cast("int"))


def picked_sql(key: str, values: list[str | None], step: int = 1) -> str:
    listed = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"[{listed}][1 + (({key} // {step}) % {len(values)})::INT]"


FORMATS = ["PARQUET", "ICEBERG", "TEXT", None]
PLACES = ["s3a://b/t", "s3a://b/u/", None]


@query(f"""
WITH c AS (SELECT c_custkey, c_custkey % 2 = 0 AS e, (c_custkey // 2) % 2 = 0 AS r, {picked_sql('c_custkey', FORMATS, 4)} AS f, {picked_sql('c_custkey', PLACES, 16)} AS l FROM customer)
SELECT c_custkey, CASE WHEN e AND r AND f = 'ICEBERG' THEN 'REFUSE' WHEN e AND NOT r AND l = 's3a://b/u/' THEN 'REFUSE' WHEN e AND r THEN 'RECREATE' WHEN e THEN 'REPAIR' ELSE 'CREATE' END AS decision,
  CASE WHEN e AND r AND f = 'ICEBERG' THEN 'converted' WHEN e AND NOT r AND l = 's3a://b/u/' THEN 'moved' END AS why FROM c""")
def creation_decisions(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "customer").select(
        "c_custkey", (F.col("c_custkey") % 2 == 0).alias("e"), (F.floor(F.col("c_custkey") / 2) % 2 == 0).alias("r"),
        picked("c_custkey", FORMATS, 4).alias("f"), picked("c_custkey", PLACES, 16).alias("l"))
    made = rows.select("c_custkey", lifecycle.creation_decision("e", "r", "f", "l", F.lit("s3://b/t")).alias("x"))
    why = F.when(F.col("x.reason").contains("already converted"), "converted").when(F.col("x.reason").contains("s3a://b/u, "), "moved")
    return made.select("c_custkey", "x.decision", why.alias("why"))


KINDS = ["TEXT", "PARQUET", "ICEBERG", "VIEW", "UNKNOWN"]
TYPES = ["EXTERNAL_TABLE", "MANAGED_TABLE", None]
STATES = ["READY", "BACKUP_CONFLICT", "UNRECOVERABLE", "ROLLBACK_BLOCKED", "ALREADY_MIGRATED", "STAGING_CLEARED", "ROLLED_BACK"]


@query(f"""
WITH o AS (SELECT o_orderkey, {picked_sql('o_orderkey', KINDS)} AS k, coalesce({picked_sql('o_orderkey', TYPES, 5)}, '') AS t, {picked_sql('o_orderkey', STATES, 15)} AS s,
  o_custkey % 4 <> 0 AS i, o_custkey % 3 = 0 AS off FROM orders),
x AS (SELECT *, k = 'TEXT' AND i AS tx, t LIKE '%EXTERNAL%' AS ext FROM o),
y AS (SELECT *, CASE WHEN i AND k = 'ICEBERG' THEN 'ALREADY_ICEBERG' WHEN k = 'VIEW' THEN 'SOURCE_IS_VIEW' WHEN tx AND off THEN 'TEXT_FORMAT_INPLACE_UNSUPPORTED'
  WHEN tx AND NOT ext THEN 'MANAGED_TEXT_INPLACE_UNSUPPORTED' WHEN tx AND s = 'BACKUP_CONFLICT' THEN 'INPLACE_CTAS_BACKUP_CONFLICT'
  WHEN tx AND s IN ('UNRECOVERABLE', 'ROLLBACK_BLOCKED') THEN 'INPLACE_CTAS_SWAP_INCOMPLETE' WHEN tx AND s = 'ALREADY_MIGRATED' THEN NULL
  WHEN i AND k = 'UNKNOWN' THEN 'FORMAT_UNDETECTED_INPLACE' END AS code FROM x)
SELECT o_orderkey, CASE WHEN code IS NOT NULL THEN 'NONE' WHEN tx AND s = 'ALREADY_MIGRATED' THEN 'DONE' WHEN i THEN 'IN_PLACE_COPY' ELSE 'COPY' END AS path, code,
  CASE WHEN code = 'INPLACE_CTAS_SWAP_INCOMPLETE' THEN 'FAILED' WHEN code IS NOT NULL THEN 'SKIPPED' WHEN tx AND s = 'ALREADY_MIGRATED' THEN 'COMPLETED' END AS status FROM y""")
def conversion_decisions(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").select(
        "o_orderkey", picked("o_orderkey", KINDS).alias("k"), picked("o_orderkey", TYPES, 5).alias("t"),
        picked("o_orderkey", STATES, 15).alias("s"), (F.col("o_custkey") % 4 != 0).alias("i"), (F.col("o_custkey") % 3 == 0).alias("off"))
    on = lifecycle.conversion_decision("k", "t", "i", "s")
    off = lifecycle.conversion_decision("k", "t", "i", "s", text_enabled=False)
    return rows.select("o_orderkey", F.when(F.col("off"), off).otherwise(on).alias("x")).select("o_orderkey", "x.path", "x.code", "x.status")


@query("""
WITH p AS (SELECT p_partkey, p_partkey % 2 = 0 AS live, (p_partkey // 2) % 2 = 0 AS backup, (p_partkey // 4) % 2 = 0 AS staging, CASE (p_partkey // 8) % 3 WHEN 0 THEN true WHEN 1 THEN false END AS done,
  CASE (p_partkey // 24) % 3 WHEN 0 THEN true WHEN 1 THEN false END AS ours FROM part)
SELECT p_partkey, CASE WHEN NOT live AND NOT backup THEN 'UNRECOVERABLE' WHEN NOT live AND NOT coalesce(ours, false) THEN 'ROLLBACK_BLOCKED' WHEN NOT live THEN 'ROLLED_BACK'
  WHEN coalesce(done, false) THEN 'ALREADY_MIGRATED' WHEN backup THEN 'BACKUP_CONFLICT' WHEN staging THEN 'STAGING_CLEARED' ELSE 'READY' END AS swap,
  CASE WHEN NOT live THEN 'SKIPPED_NOT_FOUND' WHEN NOT coalesce(done, false) THEN 'SKIPPED_NOT_ICEBERG' WHEN backup THEN 'CLEANED' ELSE 'DRY_RUN' END AS cleanup FROM p""")
def swap_and_cleanup(spark: SparkSession, d: str) -> DataFrame:
    """What interrupted swaps need, and what a clean-up does, for every combination of what is there."""
    def flag(step: int):
        return F.floor(F.col("p_partkey") / step) % 2 == 0

    def maybe(step: int):
        third = F.floor(F.col("p_partkey") / step) % 3
        return F.when(third == 0, F.lit(True)).when(third == 1, F.lit(False))

    rows = read(spark, d, "part").select("p_partkey", flag(1).alias("live"), flag(2).alias("backup"), flag(4).alias("staging"),
                                         maybe(8).alias("done"), maybe(24).alias("ours"))
    known = F.coalesce("done", F.lit(False))
    cleanup = F.when(F.col("backup"), lifecycle.cleanup_decision("live", known, dry_run=False)).otherwise(
        lifecycle.cleanup_decision("live", known))
    return rows.select("p_partkey", lifecycle.swap_state("live", "backup", "staging", "done", "ours").alias("swap"), cleanup.alias("cleanup"))


# ------------------------------------------------------------------ verdicts with schemas


@query("""
WITH s AS (SELECT l_suppkey % 8 AS k, 'sup_'||l_suppkey AS tbl, count(*) AS n, count(DISTINCT year(l_shipdate)) AS p,
  count(*) FILTER (year(l_shipdate) <> 1995) AS m, count(DISTINCT CASE WHEN year(l_shipdate) <> 1995 THEN year(l_shipdate) END) AS q FROM lineitem GROUP BY 1, 2),
t AS (SELECT tbl, n AS source_rows, CASE WHEN k IN (1, 3) THEN m ELSE n END AS dest_rows, k IN (2, 3) AS bad, k IN (4, 5) AS bad_key, p, CASE WHEN k IN (1, 3) THEN q ELSE p END AS q FROM s
  UNION ALL SELECT 'empty_'||tbl, 0, 0, false, false, 1, 1 FROM s WHERE k = 6)
SELECT tbl, source_rows::BIGINT AS source_rows, dest_rows::BIGINT AS dest_rows,
  CASE WHEN bad OR bad_key THEN 'VALIDATION_FAILED' WHEN source_rows <> dest_rows OR p <> q THEN 'VALIDATED_WITH_WARNINGS' WHEN source_rows = 0 THEN 'EMPTY_SOURCE' ELSE 'VALIDATED' END AS status,
  CASE WHEN bad THEN 'Schema differences: ' ELSE '' END||CASE WHEN bad_key THEN 'Partition schema differences: ' ELSE '' END AS heads FROM t""")
def reconcile_verdict(spark: SparkSession, d: str) -> DataFrame:
    """Counts, schemas and partition columns of one table per supplier; some lack a year, a type or a key."""
    lines = read(spark, d, "lineitem").select(
        F.concat(F.lit("sup_"), F.col("l_suppkey").cast("string")).alias("tbl"), (F.col("l_suppkey") % 8).alias("k"),
        F.year("l_shipdate").alias("year"))
    tables = lines.select("tbl", "k").distinct()
    empty = tables.where("k = 6").select(F.concat(F.lit("empty_"), F.col("tbl")).alias("tbl"), F.lit(7).cast("bigint").alias("k"))
    none = empty.select("tbl", F.lit(0).cast("bigint").alias("row_count"), F.lit("year=1995").alias("spec"))

    def counts(df: DataFrame) -> DataFrame:
        return partitions.partition_counts(df, ["year"], ["tbl"]).select("tbl", "row_count", "spec").unionByName(none)

    def catalog(dest: bool) -> DataFrame:
        wrong = (F.col("k").isin(2, 3) & F.lit(dest))
        fields = F.array(
            F.struct(F.lit(0).alias("pos"), F.lit("id").alias("name"), F.when(wrong, "string").otherwise("bigint").alias("type"), F.lit(False).alias("is_partition")),
            F.struct(F.lit(1).alias("pos"), F.lit("year").alias("name"), F.when(F.col("k").isin(4, 5) & F.lit(dest), "string").otherwise("int").alias("type"),
                     F.lit(True).alias("is_partition")))
        return tables.unionByName(empty).select("tbl", F.explode(fields).alias("f")).select("tbl", "f.*")

    source, dest = catalog(False), catalog(True)
    plain = F.col("is_partition") == F.lit(False)
    out = reconcile.reconcile(
        counts(lines), counts(lines.where(~F.col("k").isin(1, 3) | (F.col("year") != 1995))), ["tbl"], ["spec"],
        schemas.compare_schemas(source.where(plain), dest.where(plain), ["tbl"]), schemas.compare_partition_columns(source, dest, ["tbl"]))
    message = F.coalesce("error_message", F.lit(""))
    heads = F.concat(F.when(message.rlike("(^|; )Schema differences: "), "Schema differences: ").otherwise(""),
                     F.when(message.contains("Partition schema differences: "), "Partition schema differences: ").otherwise(""))
    return out.select("tbl", "source_rows", "dest_rows", "status", heads.alias("heads"))


@query("""
WITH c AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS a, CASE (c_custkey // 3) % 3 WHEN 0 THEN true WHEN 1 THEN false END AS b,
  CASE (c_custkey // 9) % 3 WHEN 0 THEN true WHEN 1 THEN false END AS s FROM customer)
SELECT c_custkey, row_number() OVER (ORDER BY a NULLS FIRST, b NULLS FIRST, s NULLS FIRST, c_custkey)::BIGINT AS place FROM c QUALIFY place <= 50""")
def worst_first(spark: SparkSession, d: str) -> DataFrame:
    """The first fifty checked tables of a report that puts failed and unknown checks first."""
    def check(step: int):
        third = F.floor(F.col("c_custkey") / step) % 3
        return F.when(third == 0, F.lit(True)).when(third == 1, F.lit(False))

    checked = read(spark, d, "customer").select("c_custkey", check(1).alias("row_count_match"), check(3).alias("partition_count_match"),
                                                check(9).alias("schema_match"))
    top = state.worst_first(checked, ["c_custkey"]).limit(50)  # the report's length
    return top.select("c_custkey", (F.monotonically_increasing_id() + 1).alias("place"))


# ------------------------------------------------------------------ error classes

SAMPLES = [(code, f"Job aborted: {phrases[0]} (x)") for code, phrases in errors.MIGRATION_CODES] + [("MIGRATION_ERROR", "something else")]


@query(f"""
SELECT event_id, {picked_sql('event_id', [c for c, _ in SAMPLES])} AS code FROM events""")
def every_error_class(spark: SparkSession, d: str) -> DataFrame:
    said = read(spark, d, "events").select("event_id", picked("event_id", [m for _, m in SAMPLES]).alias("message"))
    return said.select("event_id", errors.migration_code("message").alias("code"))


# ------------------------------------------------------------------ copies and conversions


@query("""
WITH o AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS p FROM orders)
SELECT coalesce('p='||p, 'p=__HIVE_DEFAULT_PARTITION__') AS spec, true AS copied, count(*)::BIGINT AS row_count FROM o GROUP BY p""")
def copy_null_partition(spark: SparkSession, d: str) -> DataFrame:
    """A copy of all partitions, one of which holds the rows without a value."""
    rows = read(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("p"))
    specs = rows.select("p").distinct().select(partitions.make_spec("p").alias("spec"))
    path = scratch_path(spark, "copied")
    report = lifecycle.copy_partitions(rows, specs, path, ["p"])
    there = partitions.partition_counts(datasets.read_parquet_tree(spark, path), ["p"]).select("spec", "row_count")
    return report.join(there, "spec", "left").select("spec", "copied", F.coalesce("row_count", F.lit(0)).alias("row_count"))


@query("""
SELECT 'COMPLETED' AS status, count(*)::BIGINT AS source_rows, count(*)::BIGINT AS dest_rows, true AS same_content, count(*)::BIGINT AS table_rows,
  sum(o_orderkey)::BIGINT AS key_sum FROM orders""")
def convert_in_place(spark: SparkSession, d: str) -> DataFrame:
    """orders as an ORC table, converted to Parquet with its keys in another order than its columns."""
    db = f"convert_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, "orders_orc")
    orders = read(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"),
                                             F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"))
    orders.write.orc(path)
    spark.sql(f"CREATE DATABASE {db}")
    spark.sql(f"CREATE TABLE {db}.orders USING orc LOCATION {lifecycle.literal(path)}")
    done = lifecycle.convert_in_place(spark, db, "orders", "parquet", ["status", "year"])
    through = spark.table(f"{db}.orders").agg(F.count("*").alias("table_rows"), F.sum("o_orderkey").alias("key_sum")).first()
    out = done.select("status", "source_rows", "dest_rows", "same_content", F.lit(through["table_rows"]).cast("bigint").alias("table_rows"),
                      F.lit(through["key_sum"]).cast("bigint").alias("key_sum"))
    rows = out.collect()  # one row
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return spark.createDataFrame(rows, out.schema)
