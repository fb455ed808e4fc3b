"""Table lifecycles in the catalog: interrupted conversions, registration, listings, clean-up."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lifecycle, partitions, registering
from ..session import concurrently, scratch_path
from ..sources import catalog, files, listing
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


def new_database(spark: SparkSession, lead: str) -> str:
    db = f"{lead}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db}")
    return db


def taken_out(spark: SparkSession, found: DataFrame, *dbs: str) -> DataFrame:
    """The rows of a small result, after its databases are gone."""
    rows = found.collect()
    for db in dbs:
        spark.sql(f"DROP DATABASE {db} CASCADE")
    return spark.createDataFrame(rows, found.schema)


# ------------------------------------------------------------------ interrupted conversions


class Stopped(Exception):
    """An interrupted run."""


#: Where the first run stops, what happens before the second one, and what the second one finds.
CASES = (
    ("never", "", "READY"), ("START", "", "READY"), ("COPIED", "", "READY"), ("STAGED", "", "RESUMED"),
    ("BACKED_UP", "", "ROLLED_FORWARD"), ("SWAPPED", "", "ALREADY_MIGRATED"), ("DONE", "", "ALREADY_MIGRATED"),
    ("STAGED", "rows added", "STAGING_CLEARED"), ("BACKED_UP", "staging lost", "ROLLED_BACK"),
    ("done", "another format", "BACKUP_CONFLICT"), ("BACKED_UP", "backup moved", "ROLLBACK_BLOCKED"),
    ("BACKED_UP", "backup lost", "UNRECOVERABLE"), ("view", "", "READY"))
REFUSED = {"BACKUP_CONFLICT": ("SKIPPED", "INPLACE_CTAS_BACKUP_CONFLICT"), "ROLLBACK_BLOCKED": ("FAILED", "INPLACE_CTAS_SWAP_INCOMPLETE"),
           "UNRECOVERABLE": ("FAILED", "INPLACE_CTAS_SWAP_INCOMPLETE")}
GONE = ("ROLLBACK_BLOCKED", "UNRECOVERABLE")


def _case_sql(i: int, stop: str, change: str, state: str) -> str:
    status, code = ("SKIPPED", "SOURCE_IS_VIEW") if stop == "view" else REFUSED.get(state, ("COMPLETED", None))
    rows = "0 * count(*)" if state in GONE else ("count(*) + 1" if change == "rows added" else "count(*)")
    keys = "0" if state in GONE else "coalesce(sum(c_custkey), 0)"
    backup = stop != "view" and state != "UNRECOVERABLE"
    return (f"SELECT '{stop}' AS stop, '{change}' AS change, '{state}' AS state, '{status}' AS status, "
            f"{'NULL' if code is None else repr(code)} AS code, ({rows})::BIGINT AS table_rows, ({keys})::BIGINT AS key_sum, "
            f"{str(backup).lower()} AS backup_left, false AS staging_left FROM customer WHERE c_custkey % {len(CASES)} = {i}")


@query(" UNION ALL ".join(_case_sql(i, *c) for i, c in enumerate(CASES)))
def crash_safe_conversion(spark: SparkSession, d: str) -> DataFrame:
    """customer dealt out to one ORC table per way in which a conversion can be interrupted; each is converted again."""
    db, path, journals = new_database(spark, "crash"), scratch_path(spark, "crash"), scratch_path(spark, "journals")
    dealt = read(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", (F.col("c_custkey") % len(CASES)).alias("case"))
    dealt.write.partitionBy("case").orc(path)

    def run(session: SparkSession, numbered: tuple) -> tuple:
        i, (stop, change, _) = numbered
        name, place = f"{db}.t{i}", f"{path}/case={i}"
        if stop == "view":
            session.sql(f"CREATE VIEW {name} AS SELECT * FROM orc.`{place}`")
        else:
            session.sql(f"CREATE TABLE {name} (c_custkey BIGINT, c_name STRING, c_mktsegment STRING) USING orc "
                        f"LOCATION {lifecycle.literal(place)}")

        def stopping(step: str) -> None:
            if step == stop:
                raise Stopped

        def convert(fmt: str = "parquet", on_step=None):
            return lifecycle.convert_in_place(session, db, f"t{i}", fmt, ["c_mktsegment"], journals=journals,
                                              on_step=on_step).first()

        if stop not in ("never", "view"):
            try:
                convert(on_step=stopping)
            except Stopped:
                pass
        staging, backup = name + lifecycle.STAGING_ENDING, name + lifecycle.BACKUP_ENDING
        if change == "rows added":
            session.sql(f"INSERT INTO {name} VALUES (0, 'late', 'LATE')")
        elif change == "staging lost":
            session.sql(f"DROP TABLE {staging}")
        elif change in ("backup moved", "backup lost"):
            session.sql(f"DROP TABLE {staging}")
            session.sql(f"DROP TABLE {backup}")
            if change == "backup moved":
                session.sql(f"CREATE TABLE {backup} (c_custkey BIGINT) USING orc LOCATION {lifecycle.literal(path + '/elsewhere')}")
        done = convert("json" if change == "another format" else "parquet")
        there = {n: session.catalog.tableExists(n) for n in (name, staging, backup)}
        held = session.table(name).agg(F.count("*"), F.coalesce(F.sum("c_custkey"), F.lit(0))).first() if there[name] else (0, 0)
        return (stop, change, done["state"], done["status"], done["code"], held[0], held[1], there[backup], there[staging])

    rows = list(concurrently(spark, enumerate(CASES), run, 4))
    return taken_out(spark, spark.createDataFrame(
        rows, "stop string, change string, state string, status string, code string, table_rows bigint, key_sum bigint, "
              "backup_left boolean, staging_left boolean"), db)


# ------------------------------------------------------------------ catalog listings


@query("""
WITH p AS (SELECT strftime(o_orderdate, '%Y') AS y, o_orderstatus AS s FROM orders)
SELECT 'sales' AS db, 'by_year' AS tbl, 'EXTERNAL' AS table_type, 'PARQUET' AS format, 'orders_by_year' AS folder, 'year' AS keys, count(DISTINCT y)::BIGINT AS partitions FROM p
UNION ALL SELECT 'sales', 'by_year_status', 'EXTERNAL', 'ORC', 'orders_by_year_status', 'year, status', count(DISTINCT (y, s)) FROM p
UNION ALL SELECT 'sales', 'names', 'VIEW', 'VIEW', NULL, '', 0
UNION ALL SELECT 'staff', 'clerks', 'EXTERNAL', 'TEXT', 'clerks_csv', '', 0""")
def catalog_listing(spark: SparkSession, d: str) -> DataFrame:
    """All tables of two databases with type, format, place and partitions: one description a database."""
    sales, staff, path = new_database(spark, "sales"), new_database(spark, "staff"), scratch_path(spark, "listed")
    orders = read(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy").alias("year"),
                                             F.col("o_orderstatus").alias("status"))
    made = ((sales, "by_year", "parquet", "orders_by_year", ["year"]), (sales, "by_year_status", "orc", "orders_by_year_status", ["year", "status"]),
            (staff, "clerks", "csv", "clerks_csv", []))
    for db, tbl, fmt, folder, keys in made:
        place = f"{path}/{folder}"
        lifecycle.write_partitioned(orders.select("o_orderkey", *keys), place, keys, fmt)
        spark.sql(lifecycle.external_ddl(db, tbl, [("o_orderkey", "bigint")], [(k, "string") for k in keys], place, fmt))
        if keys:
            spark.sql(f"ALTER TABLE {db}.{tbl} RECOVER PARTITIONS")
    spark.sql(f"CREATE VIEW {sales}.names AS SELECT 1 AS n")
    found = catalog.describe_tables(spark, [sales, staff])
    counts = catalog.all_partitions(spark, found).groupBy("db", "tbl").agg(F.count("*").alias("partitions"))
    shown = found.join(counts, ["db", "tbl"], "left").select(
        F.regexp_replace("db", "_[0-9a-f]{12}$", "").alias("db"), "tbl", "table_type", "format",
        F.substring_index("location", "/", -1).alias("folder"), F.array_join("partition_columns", ", ").alias("keys"),
        F.coalesce("partitions", F.lit(0)).alias("partitions"))
    return taken_out(spark, shown, sales, staff)


# ------------------------------------------------------------------ registration


MONTHS = "SELECT DISTINCT strftime(l_shipdate,'%Y') AS y, 'year='||strftime(l_shipdate,'%Y')||'/month='||strftime(l_shipdate,'%m') AS spec FROM lineitem"


@query(f"""
WITH m AS ({MONTHS}), n AS (SELECT count(*)::BIGINT AS every, count(*) FILTER (y IN ('1995', '1996'))::BIGINT AS two, count(*) FILTER (y = '1997')::BIGINT AS one FROM m),
r AS (SELECT count(*)::BIGINT AS every, count(*) FILTER (year(l_shipdate) IN (1995, 1996))::BIGINT AS two FROM lineitem)
SELECT 'all' AS tbl, 'CREATE' AS first_action, 'REPAIR' AS second_action, 'COMPLETED' AS status, NULL::BIGINT AS added, NULL::BIGINT AS dropped, NULL::BIGINT AS kept, every AS partitions, (SELECT every FROM r) AS table_rows FROM n
UNION ALL SELECT 'chosen', 'CREATE', 'REPAIR', 'COMPLETED', two + 1, one, 0, two + 1, (SELECT two FROM r) FROM n
UNION ALL SELECT 'empty', 'CREATE', 'REPAIR', 'COMPLETED', 1, 0, 1, 2, 0 FROM n
UNION ALL SELECT 'moved', 'CREATE', 'REFUSE', 'FAILED', NULL, NULL, NULL, 0, 0 FROM n""")
def register_many(spark: SparkSession, d: str) -> DataFrame:
    """Four external tables registered twice: all partitions, other ones chosen the second time, without data, moved away."""
    db, path = new_database(spark, "many"), scratch_path(spark, "many")
    lines = read(spark, d, "lineitem").select("l_orderkey", F.date_format("l_shipdate", "yyyy").alias("year"),
                                              F.date_format("l_shipdate", "MM").alias("month"))
    lifecycle.write_partitioned(lines, f"{path}/data", ["year", "month"])
    months = read(spark, d, "lineitem").select(F.date_format("l_shipdate", "yyyy").alias("y"), month_spec("l_shipdate").alias("spec")).distinct()

    def specs(moved: str) -> DataFrame:
        places = [("all", "data"), ("chosen", "data"), ("empty", "nothing"), ("moved", moved)]
        spark.createDataFrame([], "l_orderkey bigint").write.mode("overwrite").parquet(f"{path}/nothing")
        columns = [("l_orderkey", "bigint")]
        keys = [("year", "string"), ("month", "string")]
        return spark.createDataFrame([(db, t, f"{path}/{p}", "parquet", columns, [] if t == "moved" else keys) for t, p in places],
                                     "db string, tbl string, location string, format string, columns array<struct<name:string,type:string>>, "
                                     "partition_columns array<struct<name:string,type:string>>")

    def chosen(*years: str, empty: tuple[str, ...]) -> DataFrame:
        fixed = spark.createDataFrame([(db, t, s) for t, s in (("chosen", "year=1900/month=01"), *(("empty", e) for e in empty))],
                                      "db string, tbl string, spec string")
        some = months.where(F.col("y").isin(*years)).select(F.lit(db).alias("db"), F.lit("chosen").alias("tbl"), "spec")
        return some.unionByName(fixed if len(years) > 1 else fixed.where("tbl <> 'chosen'"))

    first = registering.register_tables(spark, specs("nothing"), selected=chosen("1997", empty=("year=2000/month=01",)))
    second = registering.register_tables(spark, specs("elsewhere"), selected=chosen(
        "1995", "1996", empty=("year=2000/month=01", "year=2000/month=02")))
    listed = catalog.all_partitions(spark, catalog.describe_tables(spark, [db])).groupBy("tbl").agg(F.count("*").alias("partitions"))
    held = [(t, spark.table(f"{db}.{t}").count()) for t in ("all", "chosen", "empty", "moved")]
    held = spark.createDataFrame(held, "tbl string, table_rows bigint")
    shown = (first.select("tbl", F.col("action").alias("first_action"))
             .join(second.withColumnRenamed("action", "second_action"), "tbl").join(held, "tbl").join(listed, "tbl", "left")
             .select("tbl", "first_action", "second_action", "status", "added", "dropped", "kept",
                     F.coalesce("partitions", F.lit(0)).alias("partitions"), "table_rows"))
    return taken_out(spark, shown, db)


@query("""
WITH n AS (SELECT count(*)::BIGINT AS n, count(DISTINCT o_orderstatus)::BIGINT AS p, count(*) FILTER (o_orderstatus = 'F')::BIGINT AS f FROM orders)
SELECT 'first' AS run, 'VALIDATED' AS status, n AS table_rows, n AS file_rows, p AS registered_partitions, p AS written_partitions, NULL AS error FROM n
UNION ALL SELECT 'rows from elsewhere', 'VALIDATION_FAILED', n + f, n, p + 1, p, 'row count mismatch: table='||(n + f)||' files='||n FROM n
UNION ALL SELECT 'other place', 'SKIPPED', NULL, NULL, NULL, NULL, 'the table exists at another location' FROM n""")
def register_checked(spark: SparkSession, d: str) -> DataFrame:
    """A Parquet tree registered and checked: sound, with a partition that lies elsewhere, and from another place."""
    db, path = new_database(spark, "checked"), scratch_path(spark, "checked")
    orders = read(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    lifecycle.write_partitioned(orders, f"{path}/t", ["status"])
    orders.where("status = 'F'").drop("status").write.parquet(f"{path}/extra")
    sound = lifecycle.register_parquet(spark, db, "t", f"{path}/t").withColumn("run", F.lit("first"))
    spark.sql(f"ALTER TABLE {db}.t ADD PARTITION (status = 'X') LOCATION {lifecycle.literal(path + '/extra')}")
    mixed = lifecycle.register_parquet(spark, db, "t", f"{path}/t").withColumn("run", F.lit("rows from elsewhere"))
    moved = lifecycle.register_parquet(spark, db, "t", f"{path}/extra").withColumn("run", F.lit("other place"))
    return taken_out(spark, sound.unionByName(mixed).unionByName(moved).drop("db", "tbl"), db)


# ------------------------------------------------------------------ clean-up


@query("""
WITH n AS (SELECT count(*)::BIGINT AS n FROM supplier)
SELECT * FROM (VALUES ('converted', 'DRY_RUN', 'CLEANED', false, false), ('other', 'SKIPPED_NOT_ICEBERG', 'SKIPPED_NOT_ICEBERG', true, true),
  ('none', 'SKIPPED_NOT_FOUND', 'SKIPPED_NOT_FOUND', false, false), ('shown', 'DRY_RUN', 'FAILED', true, false)) t(tbl, planned, done, listed, metadata_left),
  (SELECT n AS data_rows FROM n)""")
def cleanup_applied(spark: SparkSession, d: str) -> DataFrame:
    """Clean-up planned and applied: a converted table, another one, an unknown name, and a view that cannot be dropped so."""
    db, path = new_database(spark, "cleanup"), scratch_path(spark, "cleanup")
    suppliers = read(spark, d, "supplier").select("s_suppkey")
    for tbl, fmt in (("converted", "parquet"), ("other", "orc")):
        suppliers.write.format(fmt).save(f"{path}/{tbl}")
        suppliers.limit(1).write.json(f"{path}/{tbl}/metadata")
        spark.sql(f"CREATE TABLE {db}.{tbl} (s_suppkey BIGINT) USING {fmt} LOCATION {lifecycle.literal(f'{path}/{tbl}')}")
    spark.sql(f"CREATE VIEW {db}.shown AS SELECT * FROM {db}.converted")
    names = [f"{db}.{t}" for t in ("shown", "converted", "other", "none")]
    planned = lifecycle.cleanup_tables(spark, names, lambda n: not n.endswith(".other")).select("name", F.col("status").alias("planned"))
    planned = spark.createDataFrame(planned.collect(), planned.schema)
    done = lifecycle.cleanup_tables(spark, names, lambda n: not n.endswith(".other"), dry_run=False, width=1).select(
        "name", F.col("status").alias("done"))
    left = listing.list_entries(spark, path).where("is_dir and rel_path like '%/metadata'").select(
        F.substring_index("rel_path", "/", 1).alias("tbl"), F.lit(True).alias("metadata_left"))
    listed = catalog.tables(spark, db).select("tbl", F.lit(True).alias("listed"))
    rows = spark.read.parquet(f"{path}/converted").where("s_suppkey is not null").count()
    shown = planned.join(done, "name").withColumn("tbl", F.substring_index("name", ".", -1)).join(listed, "tbl", "left").join(
        left, "tbl", "left").select("tbl", "planned", "done", F.coalesce("listed", F.lit(False)).alias("listed"),
                                    F.coalesce("metadata_left", F.lit(False)).alias("metadata_left"), F.lit(rows).cast("bigint").alias("data_rows"))
    return taken_out(spark, shown, db)


# ------------------------------------------------------------------ inventories


@query("""
WITH l AS (SELECT lang, count(*)::BIGINT AS n FROM documents GROUP BY 1)
SELECT root, folder, lang, 1::BIGINT AS files, CASE WHEN folder = 'shown' THEN 1 ELSE 0 END::BIGINT AS seen_by_reader, n AS rows
FROM l, (VALUES ('a'), ('b')) r(root), (VALUES ('shown'), ('_held'), ('.gone')) f(folder)
UNION ALL SELECT root, 'empty', 'none', 0, 0, 0 FROM (VALUES ('a'), ('b')) r(root)""")
def hidden_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of two trees per language, also under names that Spark's listing hides; an empty directory of each tree."""
    path, docs = scratch_path(spark, "hidden"), read(spark, d, "documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("lang"))
    docs = docs.repartition(1, "lang")  # one file a language
    for root in ("a", "b"):
        for folder in ("shown", "_held", ".gone"):
            docs.write.partitionBy("lang").parquet(f"{path}/{root}/{folder}")
        files.make_directory(spark, f"{path}/{root}/empty/lang=none")
    entries = listing.list_entries(spark, [f"{path}/a", f"{path}/b"])
    pieces = F.split("rel_path", "/")
    where = [F.substring_index("root", "/", -1).alias("root"), pieces[0].alias("folder"), F.substring_index(pieces[1], "=", -1).alias("lang")]
    folders = entries.where("is_dir and rel_path like '%/lang=%'").select(*where)
    data = entries.where(~F.col("is_dir") & F.col("rel_path").rlike(r"/part-[^/]*$")).groupBy(*where).agg(F.count("*").alias("files"))
    plain = files.file_inventory(spark, f"{path}/a").unionByName(files.file_inventory(spark, f"{path}/b")).groupBy(*where).agg(
        F.count("*").alias("seen_by_reader"))
    counts = docs.groupBy("lang").agg(F.count("*").alias("rows"))
    keys = ["root", "folder", "lang"]
    return folders.join(data, keys, "left").join(plain, keys, "left").join(counts, "lang", "left").select(
        *keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("files", "seen_by_reader")],
        F.when(F.col("folder") == "empty", F.lit(0)).otherwise(F.col("rows")).cast("bigint").alias("rows"))
