"""Run and status history as an append-only event log with a latest-state view.

Each event is one phase's word on one slice: run_id, slice keys, phase, attempt, is_checkpoint, seq,
status, error_message and any payload columns. ``seq`` comes from the caller, never from a clock.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import errors
from ..functions.keys import slice_key
from ..functions.metrics import GIB, MIB, ratio
from ..functions.text import reason_code
from ..session import scratch_path
from . import ordered

# Phases of a table copy in order, and the statuses of each flow.
PHASES = ("discovery", "copy", "create", "count", "validate", "reconcile")
SKIPPABLE = ("TABLE_NOT_FOUND", "DATABASE_NOT_FOUND", "SOURCE_PATH_NOT_FOUND", "TABLE_CORRUPTED",
             "DESTINATION_PATH_INVALID", "SKIPPED_VIEW")
STICKY = ("FAILED", "EMPTY_SOURCE", *SKIPPABLE)
SLICE = ("run_id", "source_database", "source_table", "dest_database", "partition_filter")
FLOWS = {
    "copy": {
        "successful": ("VALIDATED", "VALIDATED_WITH_WARNINGS", "TABLE_CREATED", "EMPTY_SOURCE", *SKIPPABLE),
        "failed": ("FAILED", "VALIDATION_FAILED"),
        "missing": tuple(s for s in SKIPPABLE if s != "SKIPPED_VIEW"),
        "with_failures": "COMPLETED_WITH_FAILURES",
    },
    "conversion": {
        "successful": ("VALIDATED", "COMPLETED"),
        "failed": ("FAILED", "VALIDATION_FAILED"),
        "missing": (),
        "with_failures": "COMPLETED_WITH_FAILURES",
    },
    "catalog": {
        "successful": ("VALIDATED",),
        "failed": ("FAILED", "VALIDATION_FAILED"),
        "missing": ("DATA_MISSING",),
        "with_failures": "COMPLETED_WITH_FAILURES",
    },
    "registration": {
        "successful": ("REGISTERED", "VALIDATED"),
        "failed": ("FAILED", "VALIDATION_FAILED"),
        "missing": (),
        "with_failures": "COMPLETED_WITH_FAILURES",
    },
    "folder": {
        "successful": ("VALIDATED", "EMPTY_SOURCE", "SOURCE_NOT_FOUND"),
        "failed": ("FAILED", "VALIDATION_FAILED", "VALIDATION_SKIPPED"),
        "missing": (),
        "with_failures": "COMPLETED_WITH_ERRORS",
    },
    "policy": {
        "successful": ("CREATED", "UPDATED", "ALREADY_EXISTS"),
        "failed": ("FAILED",),
        "missing": (),
        "with_failures": "PARTIAL_FAILURE",
    },
}
RUN_ID = r"run_\d{8}_\d{6}_[0-9a-f]{8}"

EVENT_DDL = (
    "run_id string, source_database string, source_table string, dest_database string, partition_filter string, "
    "phase string, status string, attempt int, is_checkpoint boolean, seq bigint, error_message string"
)


# ------------------------------------------------------------------ writing and reading


def append_events(events: DataFrame, path: str) -> None:
    """Append events of any number of items in one write, one folder per run."""
    events.write.mode("append").partitionBy("run_id").parquet(path)


def read_events(spark: SparkSession, path: str, ddl: str = EVENT_DDL) -> DataFrame:
    """All events. Columns that older events lack read as NULL; a log without files is empty."""
    try:
        found = spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "UNABLE_TO_INFER_SCHEMA" in str(err):
            return spark.createDataFrame([], ddl)
        raise
    return with_columns_of(found, spark.createDataFrame([], ddl))


def with_columns_of(df: DataFrame, template: DataFrame) -> DataFrame:
    """Add the template's columns the frame lacks, as NULL, in the template's types."""
    have = {c.lower() for c in df.columns}
    for field in template.schema.fields:
        if field.name.lower() not in have:
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    return df


def compact(spark: SparkSession, path: str, keys: list[str], label: str = "compact") -> str:
    """Rewrite a log to its latest event per key and phase; returns the new folder.

    The old folder stays as it is, so a reader never meets a half-written log; the caller points new
    readers at the returned path.
    """
    target = scratch_path(spark, label)
    latest_per_phase(read_events(spark, path), keys).write.partitionBy("run_id").parquet(target)
    return target


def check_run_id(run_id) -> str:
    if not isinstance(run_id, str) or not re.fullmatch(RUN_ID, run_id):
        raise ValueError(f"not a run id: {run_id!r}")
    return run_id


def open_run(spark: SparkSession, run_id: str, started_at: str) -> DataFrame:
    return spark.createDataFrame([(run_id, "RUNNING", started_at, None)],
                                 "run_id string, status string, started_at string, completed_at string")


def close_run(outcome: DataFrame, completed_at: str) -> DataFrame:
    """Closing event of each run from its outcome."""
    return outcome.select("run_id", F.col("run_status").alias("status"),
                          F.lit(None).cast("string").alias("started_at"), F.lit(completed_at).alias("completed_at"))


def run_view(run_events: DataFrame) -> DataFrame:
    """Opening and closing events merged: one row per run."""
    return run_events.groupBy("run_id").agg(
        F.max_by("status", F.coalesce("completed_at", F.lit(""))).alias("status"),
        F.max("started_at").alias("started_at"),
        F.max("completed_at").alias("completed_at"),
    )


# ------------------------------------------------------------------ latest state


def _null_safe_slice(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumn("partition_filter", slice_key("partition_filter")) if "partition_filter" in keys else df


def settle_attempts(attempts: DataFrame, keys: list[str], message: str = "interrupted before it ended") -> DataFrame:
    """Latest attempt per identity. A checkpoint beats an in-memory result of the same attempt, and a
    latest record that still says RUNNING was interrupted: it becomes FAILED."""
    last = ordered.latest(attempts, keys, [F.col("attempt"), F.col("is_checkpoint").cast("int"), F.col("seq")])
    stuck = F.col("status") == "RUNNING"
    text = F.concat(F.lit("Attempt "), F.col("attempt").cast("string"), F.lit(f" was {message}"))
    return last.withColumn("error_message", F.when(stuck, text).otherwise(F.col("error_message"))).withColumn(
        "status", F.when(stuck, F.lit("FAILED")).otherwise(F.col("status")))


def latest_per_phase(events: DataFrame, keys: list[str]) -> DataFrame:
    """Last event of each slice and phase."""
    events = _null_safe_slice(events, keys)
    order = [F.col("attempt"), F.col("is_checkpoint").cast("int"), F.col("seq")]
    return ordered.latest(events, [*keys, "phase"], order)


def phase_rank(phase: Column) -> Column:
    """Place of a phase in the fixed order, counted from 0; an unknown phase is NULL."""
    position = F.array_position(F.array(*[F.lit(p) for p in PHASES]), phase)
    return F.when(position > 0, position - 1)


def overall_status(events: DataFrame, keys: list[str], sticky=STICKY) -> DataFrame:
    """One status per slice: the earliest sticky one by phase, else the status of the last phase."""
    per_phase = latest_per_phase(events, keys).withColumn("_rank", phase_rank(F.col("phase")))
    is_sticky = F.col("status").isin(*sticky)
    row = F.struct("status", "error_message", "phase")
    picked = per_phase.groupBy(*keys).agg(
        F.min_by(F.when(is_sticky, row), F.when(is_sticky, F.col("_rank"))).alias("_sticky"),
        F.max_by(row, F.col("_rank")).alias("_last"),
        F.count(F.lit(1)).alias("phases"),
    ).withColumn("_row", F.coalesce("_sticky", "_last"))
    return picked.select(*keys, F.col("_row.status").alias("status"), F.col("_row.phase").alias("decided_in"),
                         F.col("_row.error_message").alias("error_message"), "phases")


def merge_latest(old: DataFrame, new: DataFrame, keys: list[str], keep_when_blank: list[str],
                 order: list[Column] | None = None) -> DataFrame:
    """Update old rows by key with the last new row; listed text columns keep their old value when
    the new one is blank. Keys unknown to ``old`` are added."""
    if order:
        new = ordered.latest(new, keys, order)
    payload = [c for c in old.columns if c not in keys]
    left = old.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in payload])
    right = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in payload], F.lit(True).alias("_hit"))
    joined = left.join(right, keys, "full_outer")

    def value(c: str) -> Column:
        fresh, before = F.col(f"_new_{c}"), F.col(f"_old_{c}")
        if c in keep_when_blank:
            fresh = F.when(F.coalesce(fresh, F.lit("")) == "", before).otherwise(fresh)
        return F.when(F.col("_hit"), fresh).otherwise(before).alias(c)

    return joined.select(*keys, *[value(c) for c in payload]).select(*old.columns)


# ------------------------------------------------------------------ joins on state


def unreported(expected: DataFrame, seen: DataFrame, keys: list[str], code: str = "TASK_DID_NOT_PROCESS",
               status: str = "FAILED") -> DataFrame:
    """Expected items nobody reported on, as FAILED rows. Reports are reduced to their keys first."""
    return expected.join(seen.select(*keys).distinct(), keys, "left_anti").withColumn("status", F.lit(status)).withColumn(
        "error_message", F.lit(f"[{code}] no result was reported"))


def attach_results(tables: DataFrame, results: DataFrame, full_key: list[str], short_key: list[str],
                   payload: list[str]) -> DataFrame:
    """Result columns by the full slice key, else by the short one (the result with the least filter).

    Filters are compared null-safe.
    """
    exact = _null_safe_slice(results, full_key).select(*full_key, *payload)
    exact = ordered.latest(exact, full_key, [F.col(c).cast("string") for c in payload])
    rows = _null_safe_slice(tables, full_key)
    loose = _null_safe_slice(results, full_key).groupBy(*short_key).agg(
        F.min_by(F.struct(*payload), F.struct(*[F.col(k) for k in full_key])).alias("_loose"))
    exact = exact.select(*full_key, F.struct(*payload).alias("_exact"))
    joined = rows.join(exact, full_key, "left").join(loose, short_key, "left")
    picked = F.coalesce("_exact", "_loose")
    out = joined.withColumn("_picked", picked).withColumn(
        "matched_by", F.when(F.col("_exact").isNotNull(), F.lit("slice"))
        .when(F.col("_loose").isNotNull(), F.lit("table")).otherwise(F.lit("none")))
    return out.select(*rows.columns, *[F.col(f"_picked.{c}").alias(c) for c in payload], "matched_by")


def normalise_empty(status, source_rows, source_bytes, bytes_copied, files_copied) -> Column:
    """COMPLETED with an empty source and nothing copied becomes EMPTY_SOURCE."""
    def zero(c):
        c = F.col(c) if isinstance(c, str) else c
        return F.coalesce(c, F.lit(0)) == 0

    status = F.col(status) if isinstance(status, str) else status
    nothing = zero(source_rows) & zero(source_bytes) & zero(bytes_copied) & zero(files_copied)
    return F.when((status == "COMPLETED") & nothing, F.lit("EMPTY_SOURCE")).otherwise(status)


def with_presence(tables: DataFrame, presence: DataFrame, keys: list[str]) -> DataFrame:
    """Presence results onto discovered tables, UNKNOWN where there is none."""
    return tables.join(presence, keys, "left").withColumn("presence", F.coalesce("presence", F.lit("UNKNOWN")))


# ------------------------------------------------------------------ reports


def run_outcome(states: DataFrame, flow: str, keys: list[str] | None = None, status: str = "status") -> DataFrame:
    """Totals by outcome and the run's status, per run. Without keys an empty run is one FAILED row."""
    counted = states.withColumn("_one", F.lit(1))
    return _outcome(counted, flow, keys or [], F.col(status), F.col("_one"))


def outcomes_by_flow(counted: DataFrame, flows: list[str], keys: list[str]) -> DataFrame:
    """Outcomes of the same items under several flows, from their counts ``n`` per key and status."""
    rows = counted.withColumn("flow", F.explode(F.array(*[F.lit(f) for f in flows])))
    value, n = F.col("status"), F.col("n")

    def total(kind: str) -> Column:
        test = F.lit(False)
        for flow in flows:
            test = test | ((F.col("flow") == flow) & value.isin(*FLOWS[flow][kind]))
        return F.coalesce(F.sum(F.when(test, n)), F.lit(0))

    out = rows.groupBy("flow", *keys).agg(
        F.sum(n).alias("total"), total("successful").alias("successful"), total("failed").alias("failed"),
        total("missing").alias("missing"),
        F.coalesce(F.sum(F.when(value.isin("SKIPPED", "SKIPPED_VIEW"), n)), F.lit(0)).alias("skipped"))
    word = F.lit(None).cast("string")
    for flow in flows:
        word = F.when(F.col("flow") == flow, F.lit(FLOWS[flow]["with_failures"])).otherwise(word)
    return out.withColumn("run_status", _run_status(word))


def _outcome(counted: DataFrame, flow: str, keys: list[str], value: Column, n: Column) -> DataFrame:
    rules = FLOWS[flow]

    def total(names) -> Column:
        return F.coalesce(F.sum(F.when(value.isin(*names), n)), F.lit(0)) if names else F.lit(0).cast("bigint")

    out = counted.groupBy(*keys).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total"), total(rules["successful"]).alias("successful"),
        total(rules["failed"]).alias("failed"), total(rules["missing"]).alias("missing"),
        total(("SKIPPED", "SKIPPED_VIEW")).alias("skipped"))
    return out.withColumn("run_status", _run_status(F.lit(rules["with_failures"])))


def _run_status(with_failures: Column) -> Column:
    return (
        F.when(F.col("total") == 0, F.lit("FAILED")).when(F.col("failed") > 0, with_failures)
        .when(F.col("missing") > 0, F.lit("COMPLETED_WITH_MISSING")).otherwise(F.lit("COMPLETED")))


def head_counts(states: DataFrame, flow: str, keys: list[str] | None = None) -> DataFrame:
    """Head line of a run report: tables, outcomes, rows, files, gigabytes, incremental copies."""
    rules = FLOWS[flow]
    return states.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if(F.col("status").isin(*rules["successful"])).alias("successful"),
        F.count_if(F.col("status").isin(*rules["failed"])).alias("failed"),
        F.count_if(F.col("status").isin("SKIPPED", *SKIPPABLE)).alias("skipped"),
        F.coalesce(F.sum("source_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("file_count"), F.lit(0)).alias("files"),
        (F.coalesce(F.sum("size_bytes"), F.lit(0)) / F.lit(float(GIB))).alias("gigabytes"),
        F.count_if("is_incremental").alias("incremental"),
    )


def status_counts(states: DataFrame, by: list[str]) -> DataFrame:
    """Rows per status, most frequent first."""
    return states.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *by)


def reason_breakdown(states: DataFrame, message: str = "error_message", status: str = "status") -> DataFrame:
    """How often each reason occurred per status, with its label; most frequent first, then by label."""
    text = F.trim(F.coalesce(message, F.lit("")))
    code = reason_code(message)
    label = (
        F.when(text == "", F.lit(errors.NO_REASON))
        .when(F.col("code") == "", F.lit(errors.UNLABELLED))
        .otherwise(errors.reason_label(F.col("code")))
    )
    counted = states.withColumn("_empty", text == "").withColumn("code", code).withColumn(
        "label", F.when(F.col("_empty"), F.lit(errors.NO_REASON)).otherwise(label))
    return counted.groupBy(status, "code", "label").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "label", status)


def dominant(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Most frequent value, ties by the smaller one."""
    counted = df.groupBy(*(keys or []), value).agg(F.count(F.lit(1)).alias("n"))
    if not keys:
        return counted.orderBy(F.desc("n"), value).limit(1)
    return ordered.earliest(counted, keys, [-F.col("n"), F.col(value)])


def failure_preview(failures: DataFrame, keys: list[str], item: str, order: list[Column], shown: int = 5) -> DataFrame:
    """First failures of each group as text, with the number of the others.

    Only ``shown`` rows of a group are ever put together.
    """
    counted = failures.groupBy(*keys).agg(F.count(F.lit(1)).alias("failures"))
    first = ordered.top_n(failures.select(*keys, item), keys, order, shown, rank="_rank")
    ranked = F.array_sort(F.collect_list(F.struct("_rank", F.col(item).cast("string").alias("text"))))
    texts = first.groupBy(*keys).agg(F.array_join(F.transform(ranked, lambda x: x["text"]), "; ").alias("_head"))
    rest = F.col("failures") - F.lit(shown)
    more = F.concat("_head", F.lit(" (+"), rest.cast("string"), F.lit(" more)"))
    return counted.join(texts, keys).select(
        *keys, "failures", F.when(rest > 0, more).otherwise(F.col("_head")).alias("preview"))


def table_performance(states: DataFrame, keys: list[str]) -> DataFrame:
    """GB, MB/s, end-to-end seconds and rows/s per table; skippable tables are left out."""
    seconds = [F.coalesce(c, F.lit(0)) for c in ("discovery_seconds", "copy_seconds", "create_seconds",
                                                 "validate_seconds")]
    total = seconds[0] + seconds[1] + seconds[2] + seconds[3]
    rows = states.where(~F.coalesce(F.col("status"), F.lit("")).isin(*SKIPPABLE))
    return rows.select(
        *keys,
        (F.coalesce("size_bytes", F.lit(0)) / F.lit(float(GIB))).alias("gigabytes"),
        (ratio("size_bytes", "copy_seconds") / F.lit(float(MIB))).alias("mb_per_second"),
        total.alias("total_seconds"),
        ratio("source_rows", total).alias("rows_per_second"),
    )


def worst_first(checked: DataFrame, keys: list[str]) -> DataFrame:
    """Failed and unknown checks before passed ones."""
    flags = ("row_count_match", "partition_count_match", "schema_match")
    return checked.orderBy(*[F.col(c).asc_nulls_first() for c in flags], *keys)
