"""Creating, registering, copying and converting tables, each with a check before it counts.

Statements run once per table on the driver, as catalogs take them; rows are only moved by Spark jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import col, drop_trailing_slash, object_store_uri, sibling_target
from ..functions.types import hive_type_to_ddl
from ..session import concurrently, materialize
from ..sources.catalog import table_location
from ..sources.datasets import FIELD_DELIMITER, NULL_MARKER, read_parquet_tree, text_partition_keys
from . import partitions as parts
from . import schemas
from .journal import Journal

# Name endings of the staging copy and the kept original during a swap.
STAGING_ENDING = "__ice_staging"
BACKUP_ENDING = "_backup_"


# ------------------------------------------------------------------ fingerprints


def fingerprint(df: DataFrame, keys: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Row count and an order-free checksum of the contents, whole or per key, in one aggregate.

    A hash skips NULLs, so each value goes in with its null flag; nested values go in as JSON that names them.
    """
    parts_of_hash: list[Column] = []
    for c in sorted(columns or df.columns):
        value = F.col(f"`{c}`")
        if isinstance(df.schema[c].dataType, (T.MapType, T.ArrayType, T.StructType)):
            parts_of_hash.append(F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}))
        else:
            parts_of_hash += [value.isNull(), value]
    return df.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(F.xxhash64(*parts_of_hash).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("checksum"))


def compare_contents(source: DataFrame, dest: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: counts and checksums of both sides and whether the contents are the same. A NULL key is a key."""
    shared = [c for c in source.columns if c in dest.columns]
    left = fingerprint(source, keys, shared).alias("l")
    right = fingerprint(dest, keys, shared).alias("r")
    joined = left.join(right, parts.same_values("l", "r", keys), "full_outer")
    same = F.coalesce((F.col("l.row_count") == F.col("r.row_count")) & (F.col("l.checksum") == F.col("r.checksum")),
                      F.lit(False))
    return joined.select(*[F.coalesce(f"l.`{k}`", f"r.`{k}`").alias(k) for k in keys],
                         F.coalesce("l.row_count", F.lit(0)).alias("source_rows"),
                         F.coalesce("r.row_count", F.lit(0)).alias("dest_rows"), same.alias("same_content"))


# ------------------------------------------------------------------ copying


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet",
                      mode: str = "overwrite") -> None:
    """Write with rows gathered by partition; a large partition is split over several tasks."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).format(fmt).save(path)


def copy_partitions(source: DataFrame, selected: DataFrame, path: str, partition_by: list[str]) -> DataFrame:
    """Copy the selected partitions, leaving the destination's others alone.

    Returns the selected specs with ``copied`` (false for a partition without rows, or with a value of another type).
    """
    selected = materialize(selected.select("spec").distinct(), "selected")  # read by the copy and by the report
    rows = parts.restrict(source, selected, partition_by)
    write_partitioned(rows, path, partition_by)
    full = rows.select(*partition_by).distinct().withColumn("_full", F.lit(True)).alias("r")
    asked = parts.typed_values(selected, {c: source.schema[c].dataType for c in partition_by}).alias("l")
    hit = asked.join(full, parts.same_values("l", "r", partition_by), "left_semi").select("spec", F.lit(True).alias("_full"))
    return selected.join(hit, "spec", "left").select("spec", F.coalesce("_full", F.lit(False)).alias("copied"))


# ------------------------------------------------------------------ decisions


def creation_decision(exists, recreate, existing_format, existing_location, copy_location) -> Column:
    """struct(decision, reason): CREATE, REPAIR, RECREATE or REFUSE."""
    exists, recreate = col(exists), col(recreate)
    converted = exists & recreate & (F.coalesce(col(existing_format), F.lit("")) == "ICEBERG")
    here, there = drop_trailing_slash(object_store_uri(copy_location)), drop_trailing_slash(existing_location)
    moved = exists & ~recreate & (F.coalesce(there, F.lit("")) != "") & (object_store_uri(there) != here)
    decision = (
        F.when(converted | moved, F.lit("REFUSE")).when(exists & recreate, F.lit("RECREATE"))
        .when(exists, F.lit("REPAIR")).otherwise(F.lit("CREATE")))
    reason = (
        F.when(converted, F.lit("the table was already converted; recreating it would lose that"))
        .when(moved, F.concat(F.lit("the table lies at "), there, F.lit(", the copy at "), here)))
    return F.struct(decision.alias("decision"), reason.alias("reason"))


def conversion_decision(storage_format, table_type, in_place, swap_state=None, text_enabled: bool = True) -> Column:
    """struct(path, code, status) of a conversion: COPY, IN_PLACE_COPY, DONE or NONE with a reason code."""
    kind, in_place = col(storage_format), F.coalesce(col(in_place), F.lit(False))
    external = F.upper(F.coalesce(col(table_type), F.lit(""))).contains("EXTERNAL")
    state = F.lit("READY") if swap_state is None else col(swap_state)

    def block(code: str, status: str = "SKIPPED") -> Column:
        return _decision("NONE", code, status)

    text = in_place & (kind == "TEXT")
    return (
        F.when(in_place & (kind == "ICEBERG"), block("ALREADY_ICEBERG"))
        .when(kind == "VIEW", block("SOURCE_IS_VIEW"))
        .when(text & F.lit(not text_enabled), block("TEXT_FORMAT_INPLACE_UNSUPPORTED"))
        .when(text & ~external, block("MANAGED_TEXT_INPLACE_UNSUPPORTED"))
        .when(text & (state == "BACKUP_CONFLICT"), block("INPLACE_CTAS_BACKUP_CONFLICT"))
        .when(text & state.isin("UNRECOVERABLE", "ROLLBACK_BLOCKED"), block("INPLACE_CTAS_SWAP_INCOMPLETE", "FAILED"))
        .when(text & (state == "ALREADY_MIGRATED"), _decision("DONE", None, "COMPLETED"))
        .when(in_place & (kind == "UNKNOWN"), block("FORMAT_UNDETECTED_INPLACE"))
        .when(in_place, _decision("IN_PLACE_COPY", None, None))
        .otherwise(_decision("COPY", None, None)))


def _decision(path: str, code: str | None, status: str | None) -> Column:
    return F.struct(F.lit(path).alias("path"), F.lit(code).cast("string").alias("code"),
                    F.lit(status).cast("string").alias("status"))


def swap_state(live, backup, staging, converted, backup_is_ours) -> Column:
    """What an interrupted swap needs, from which of the three names exist."""
    live, backup, staging = col(live), col(backup), col(staging)
    gone = (
        F.when(~backup, F.lit("UNRECOVERABLE")).when(~F.coalesce(col(backup_is_ours), F.lit(False)),
                                                    F.lit("ROLLBACK_BLOCKED")).otherwise(F.lit("ROLLED_BACK")))
    there = (
        F.when(F.coalesce(col(converted), F.lit(False)), F.lit("ALREADY_MIGRATED"))
        .when(backup, F.lit("BACKUP_CONFLICT")).when(staging, F.lit("STAGING_CLEARED")).otherwise(F.lit("READY")))
    return F.when(live, there).otherwise(gone)


def cleanup_decision(exists, is_converted, dry_run: bool = True) -> Column:
    return (
        F.when(~col(exists), F.lit("SKIPPED_NOT_FOUND"))
        .when(~col(is_converted), F.lit("SKIPPED_NOT_ICEBERG"))
        .otherwise(F.lit("DRY_RUN" if dry_run else "CLEANED")))


# ------------------------------------------------------------------ creating and registering


def quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def external_ddl(db: str, tbl: str, columns: list[tuple[str, str]], partition_columns: list[tuple[str, str]],
                 location: str, fmt: str = "parquet", options: dict[str, str] | None = None) -> str:
    """CREATE TABLE statement of an external table with typed partition columns."""
    both = ", ".join(f"{quoted(n)} {t}" for n, t in [*columns, *partition_columns])
    using = "csv" if fmt.upper() in ("TEXT", "TEXTFILE", "CSV") else fmt.lower()
    if using == "csv":
        options = {"sep": FIELD_DELIMITER, "nullValue": NULL_MARKER, "escape": "\\", **(options or {})}
    given = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in (options or {}).items())
    keys = ", ".join(quoted(n) for n, _ in partition_columns)
    return (
        f"CREATE TABLE {quoted(db, tbl)} ({both}) USING {using}"
        + (f" OPTIONS ({given})" if given else "")
        + (f" PARTITIONED BY ({keys})" if keys else "")
        + f" LOCATION {literal(location)}")


def table_specs(columns: DataFrame, tables: DataFrame) -> DataFrame:
    """One row per table with its column lists as Spark types, from a column catalog in Hive notation.

    ``tables`` has db, tbl, location and format.
    """
    typed = columns.withColumn("ddl_type", hive_type_to_ddl("type"))
    def listed(only: Column) -> Column:
        rows = F.array_sort(F.collect_list(F.when(only, F.struct("pos", "name", "ddl_type"))))
        return F.transform(rows, lambda x: F.struct(x["name"].alias("name"), x["ddl_type"].alias("type")))

    is_key = F.coalesce("is_partition", F.lit(False))
    lists = typed.groupBy("db", "tbl").agg(listed(~is_key).alias("columns"), listed(is_key).alias("partition_columns"))
    return tables.join(lists, ["db", "tbl"], "left")


def register_external(spark: SparkSession, specs: DataFrame, recreate: bool = False) -> DataFrame:
    """``registering.register_tables`` with the partitions that are on storage."""
    from .registering import register_tables

    return register_tables(spark, specs, recreate)


def _plain(location: str | None) -> str:
    text = (location or "").rstrip("/")
    return "/" + text[len("file:"):].lstrip("/") if text.startswith("file:") else text


def sync_partitions(spark: SparkSession, name: str) -> None:
    """Register new partition directories and drop registered ones that are gone."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def add_partitions(spark: SparkSession, name: str, location: str, specs: Iterable[str]) -> int:
    """Register an explicit list of partitions, with or without data; returns how many were given."""
    clauses = []
    for spec in specs:
        keys = ", ".join(f"{quoted(k)} = {literal(v)}" for k, v in (s.split("=", 1) for s in spec.split("/") if "=" in s))
        clauses.append(f"PARTITION ({keys}) LOCATION {literal(location.rstrip('/') + '/' + spec)}")
    for start in range(0, len(clauses), 500):  # bounded statements
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(clauses[start:start + 500]))
    return len(clauses)


def register_parquet(spark: SparkSession, db: str, tbl: str, location: str) -> DataFrame:
    """Register a Parquet tree with text partition keys and the union of all file schemas, then check it.

    One row: status, counts through the table and from the files, registered and written partitions.
    """
    name = quoted(db, tbl)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(db)}")
    tree = read_parquet_tree(spark, location)
    keys = _partition_keys(spark, location, tree.columns)
    if spark.catalog.tableExists(name):
        if _plain(table_location(spark, name)) != _plain(location):
            return _parquet_result(spark, db, tbl, "SKIPPED", None, None, None, None,
                                   "the table exists at another location")
    else:
        typed = {f.name: f.dataType.simpleString() for f in tree.schema.fields}
        columns = [(c, t) for c, t in typed.items() if c not in keys]
        if not columns:
            raise ValueError(f"no data columns found under {location}")
        spark.sql(external_ddl(db, tbl, columns, [(k, typed[k]) for k in keys], location))
    if keys:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")
    through_table = spark.table(name).count()
    from_files = tree.count()
    registered = spark.sql(f"SHOW PARTITIONS {name}").count() if keys else 0
    written = tree.select(*keys).distinct().count() if keys else 0
    problems = []
    if through_table != from_files:
        problems.append(f"row count mismatch: table={through_table} files={from_files}")
    # Empty directories are registered too, so there may be more partitions than ones with rows.
    if registered < written:
        problems.append(f"partition count mismatch: table={registered} files={written}")
    status = "VALIDATION_FAILED" if problems else "VALIDATED"
    return _parquet_result(spark, db, tbl, status, through_table, from_files, registered, written,
                           "; ".join(problems) or None)


def _partition_keys(spark: SparkSession, location: str, columns: list[str]) -> list[str]:
    from ..sources.files import file_inventory, partition_keys, partition_specs

    keys = partition_keys(partition_specs(file_inventory(spark, location)))
    missing = [k for k in keys if k not in columns]
    if missing:
        raise ValueError(f"partition column(s) {missing} are not in the schema read from {location}")
    return keys


def _parquet_result(spark, db, tbl, status, rows, files, registered, written, error) -> DataFrame:
    return spark.createDataFrame(
        [(db, tbl, status, rows, files, registered, written, error)],
        "db string, tbl string, status string, table_rows bigint, file_rows bigint, "
        "registered_partitions bigint, written_partitions bigint, error string")


# ------------------------------------------------------------------ converting


def convert_verified(spark: SparkSession, source: DataFrame, path: str, fmt: str = "parquet",
                     partition_by: list[str] | None = None) -> DataFrame:
    """Write a staging copy, compare it with the source by schema and per-partition contents, and give
    one verdict row per partition (one row for an unpartitioned copy).

    The caller swaps names only when every row says the same content.
    """
    partition_by = partition_by or []
    write_partitioned(source, path, partition_by, fmt)
    reader = spark.read.schema(source.schema) if fmt == "csv" else spark.read
    with text_partition_keys(spark):  # "01" must come back as "01"; typed keys are cast below
        copied = reader.format(fmt).load(path)
    typed = copied.select(*[F.col(f"`{c}`").cast(source.schema[c].dataType).alias(c) for c in source.columns])
    before = schemas.columns_of(spark, {("src", "t"): source})
    after = schemas.columns_of(spark, {("src", "t"): typed if partition_by else copied})
    checked = schemas.compare_schemas(before, after, normalise=True).select("schema_match", "differences").first()
    if partition_by:
        rows = compare_contents(source, typed, partition_by)
    else:
        rows = compare_contents(source.withColumn("_all", F.lit(1)), typed.withColumn("_all", F.lit(1)), ["_all"])
        rows = rows.drop("_all")
    return rows.withColumn("schema_match", F.lit(checked["schema_match"])).withColumn(
        "differences", F.lit(checked["differences"]))


def repair_swap(spark: SparkSession, db: str, tbl: str, expected_location: str | None,
                is_converted) -> str:
    """Bring an interrupted in-place conversion back to a clean start, or say why it is left alone.

    ``is_converted`` tells whether a table name already is in the target format.
    """
    names = {k: quoted(db, tbl + e) for k, e in (("live", ""), ("staging", STAGING_ENDING), ("backup", BACKUP_ENDING))}
    there = {k: spark.catalog.tableExists(n) for k, n in names.items()}
    done = there["live"] and is_converted(names["live"])
    ours = there["backup"] and bool(expected_location) and (
        _plain(table_location(spark, names["backup"])) == _plain(expected_location))
    flags = spark.createDataFrame([(there["live"], there["backup"], there["staging"], done, ours)],
                                  "live boolean, backup boolean, staging boolean, done boolean, ours boolean")
    state = flags.select(swap_state("live", "backup", "staging", "done", "ours").alias("s")).first()["s"]
    drop_staging = there["staging"] and (state == "ROLLED_BACK" or (there["live"] and not done))
    if drop_staging:
        spark.sql(f"DROP TABLE IF EXISTS {names['staging']}")
    if state == "ROLLED_BACK":
        spark.sql(f"ALTER TABLE {names['backup']} RENAME TO {names['live']}")
    return state


CONVERTED_DDL = ("db string, tbl string, status string, source_rows bigint, dest_rows bigint, same_content boolean, "
                 "schema_match boolean, state string, code string")


def convert_in_place(spark: SparkSession, db: str, tbl: str, fmt: str = "parquet",
                     partition_by: list[str] | None = None, keep_backup: bool = True, journals: str | None = None,
                     on_step: Callable[[str], None] | None = None) -> DataFrame:
    """Copy a table to a new format under its own name; the original stays as a backup.

    The copy is checked twice while the original is still live: the files against the source, then the rows that the
    staging table really gives. Names are swapped only when both agree, so a bad copy changes nothing.

    Every step is noted in a journal under ``journals`` (shared storage). It is read before anything is copied, so a run
    after an interrupted one goes on with a checked staging table, completes or takes back half a swap, or refuses.
    ``state`` says what was found, ``code`` why nothing was converted. ``on_step`` is called after each step.
    """
    run = _Conversion(spark, db, tbl, fmt, list(partition_by or []), journals, on_step or (lambda step: None))
    status, code = run.begin()
    if status is None:
        run.resume() if run.state == "RESUMED" else run.convert()
        status = "COMPLETED" if run.passed else "FAILED"
    if status == "COMPLETED":
        run.finish(keep_backup)
    return spark.createDataFrame([(db, tbl, status, run.source_rows, run.dest_rows, run.same, run.schema_match, run.state, code)],
                                 CONVERTED_DDL)


class _Conversion:
    """One run of ``convert_in_place``."""

    def __init__(self, spark, db, tbl, fmt, keys, journals, on_step):
        self.spark, self.db, self.tbl, self.fmt, self.keys, self.on_step = spark, db, tbl, fmt, keys, on_step
        self.live, self.staging, self.backup = (quoted(db, tbl + e) for e in ("", STAGING_ENDING, BACKUP_ENDING))
        self.journal = Journal(spark, db, tbl, journals)
        self.state, self.place = None, None
        self.source_rows = self.dest_rows = self.same = self.schema_match = None

    @property
    def passed(self) -> bool:
        return bool(self.same and self.schema_match)

    def _lies_at(self, name: str, place: str | None) -> bool:
        return bool(place) and _plain(table_location(self.spark, name)) == _plain(place)

    def begin(self) -> tuple[str | None, str | None]:
        """Put an interrupted swap right; (status, code) if there is nothing to convert, else (None, None)."""
        spark, start, staged = self.spark, self.journal.knows("START"), self.journal.knows("STAGED")
        there = {n: spark.catalog.tableExists(n) for n in (self.live, self.staging, self.backup)}
        wanted = bool(start) and (start["format"], start["keys"]) == (self.fmt, ",".join(self.keys))
        checked = wanted and staged is not None
        done = checked and there[self.live] and self._lies_at(self.live, start["place"])
        ours = bool(start) and there[self.backup] and self._lies_at(self.backup, start["source"])
        ready = checked and there[self.staging] and self._lies_at(self.staging, start["place"])
        view = there[self.live] and spark.catalog.getTable(self.live).tableType == "VIEW"
        facts = spark.createDataFrame(
            [(there[self.live], there[self.backup], there[self.staging], done, ours, "VIEW" if view else "TEXT")],
            "live boolean, backup boolean, staging boolean, done boolean, ours boolean, kind string")
        # a copy under another name that takes the table's place is what the decision calls the text path
        found = facts.withColumn("state", swap_state("live", "backup", "staging", "done", "ours")).select(
            "state", conversion_decision("kind", F.lit("EXTERNAL"), F.lit(True), "state").alias("d")).first()
        self.state, (path, code, status) = found["state"], found["d"]
        if self.state == "ROLLED_BACK" and ready:
            spark.sql(f"ALTER TABLE {self.staging} RENAME TO {self.live}")
            self.state, path, status = "ROLLED_FORWARD", "DONE", "COMPLETED"
        elif self.state == "ROLLED_BACK":
            spark.sql(f"ALTER TABLE {self.backup} RENAME TO {self.live}")
        elif self.state == "STAGING_CLEARED" and ready and self._unchanged(staged):
            self.state = "RESUMED"
        if self.state in ("ROLLED_BACK", "STAGING_CLEARED", "BACKUP_CONFLICT", "ALREADY_MIGRATED"):
            spark.sql(f"DROP TABLE IF EXISTS {self.staging}")
        if path == "DONE":
            self.source_rows = self.dest_rows = staged["row_count"]
            self.same = self.schema_match = True
        return status, code

    def _unchanged(self, staged) -> bool:
        """Whether the source still holds what the staging table was checked against."""
        return _content(self.spark.table(self.live)) == (staged["row_count"], staged["checksum"])

    def convert(self) -> None:
        spark, source = self.spark, self.spark.table(self.live)
        origin = table_location(spark, self.live)
        self.place = sibling_path(spark, origin)
        if any(n["place"] == self.place for n in self.journal.notes):
            _delete(spark, self.place)  # what an interrupted run left; no table lies there any more
        self._step("START", source=origin, place=self.place, format=self.fmt, keys=",".join(self.keys))
        checks = convert_verified(spark, source, self.place, self.fmt, self.keys).agg(
            F.sum("source_rows").alias("source_rows"), F.sum("dest_rows").alias("dest_rows"),
            F.coalesce(F.bool_and("same_content"), F.lit(True)).alias("same_content"),
            F.coalesce(F.bool_and("schema_match"), F.lit(True)).alias("schema_match")).first()
        self.source_rows, self.dest_rows, self.same, self.schema_match = checks
        if not self.passed:
            return
        self._step("COPIED", row_count=self.source_rows)
        typed = {f.name: f.dataType.simpleString() for f in source.schema.fields}
        # directories lie in the order of the keys, whatever the order of the columns
        spark.sql(external_ddl(self.db, self.tbl + STAGING_ENDING, [c for c in typed.items() if c[0] not in self.keys],
                               [(k, typed[k]) for k in self.keys], self.place, self.fmt))
        if self.keys:
            spark.sql(f"ALTER TABLE {self.staging} RECOVER PARTITIONS")
        before, through = _content(source), _content(spark.table(self.staging))
        self.source_rows, self.dest_rows, self.same = before[0], through[0], before == through
        if not self.passed:
            spark.sql(f"DROP TABLE IF EXISTS {self.staging}")
            return
        self._step("STAGED", row_count=before[0], checksum=before[1])
        self._swap()

    def resume(self) -> None:
        """Go on with a staging table that an earlier run has checked."""
        staged = self.journal.knows("STAGED")
        self.source_rows = self.dest_rows = staged["row_count"]
        self.same = self.schema_match = True
        self._swap()

    def _swap(self) -> None:
        self.spark.sql(f"ALTER TABLE {self.live} RENAME TO {self.backup}")
        self.on_step("BACKED_UP")  # the catalog itself tells that the names were moved
        self.spark.sql(f"ALTER TABLE {self.staging} RENAME TO {self.live}")
        self.on_step("SWAPPED")

    def finish(self, keep_backup: bool) -> None:
        if not keep_backup:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.backup}")
        if self.journal.knows("DONE") is None:
            self._step("DONE", row_count=self.source_rows)

    def _step(self, step: str, **facts) -> None:
        self.journal.note(step, **facts)
        self.on_step(step)


def _content(df: DataFrame) -> tuple:
    """(rows, checksum) of a table, its columns by name."""
    return tuple(fingerprint(df).first())


def sibling_path(spark: SparkSession, location: str) -> str:
    """Place of a converted copy: next to the original, on whatever storage that is."""
    row = spark.createDataFrame([(location,)], "location string").select(sibling_target("location").alias("p")).first()
    return row["p"] or location.rstrip("/") + STAGING_ENDING


def cleanup_tables(spark: SparkSession, names: list[str], is_converted, dry_run: bool = True, width: int = 8) -> DataFrame:
    """Drop the catalog entries of converted tables, data kept; a dry run only says what would happen.

    Looking up and dropping go on ``width`` names at a time; a table that cannot be dropped does not stop the others.
    """
    def look(session: SparkSession, name: str) -> tuple:
        exists = session.catalog.tableExists(name)
        return name, exists, bool(exists and is_converted(name)), table_location(session, name) if exists else None

    plan = spark.createDataFrame(list(concurrently(spark, names, look, width)),
                                 "name string, found boolean, converted boolean, location string")
    plan = plan.select("name", "location", cleanup_decision("found", "converted", dry_run).alias("status"))
    if dry_run:
        return plan

    def drop(session: SparkSession, row) -> tuple:
        status, error = row["status"], None
        if status == "CLEANED":
            try:
                session.sql(f"DROP TABLE IF EXISTS {row['name']}")
                if row["location"]:
                    _delete(session, row["location"].rstrip("/") + "/metadata")
            except Exception as err:  # noqa: BLE001 - one bad table must not stop the others
                status, error = "FAILED", str(err)
        return row["name"], row["location"], status, error

    return spark.createDataFrame(list(concurrently(spark, plan.toLocalIterator(), drop, width)),
                                 "name string, location string, status string, error string")


def _delete(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
