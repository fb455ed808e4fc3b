"""Copy planning: file sync, cost, batch packing, folder split, unit outcomes and failure diagnosis."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics
from ..functions.keys import identity
from ..functions.paths import ancestors, col
from ..session import materialize
from . import ordered

# Markers in a copy job's log and the texts of a memory kill.
PHASE_START = r"^PHASE_START (\w+)"
PHASE_END = r"^PHASE_END (\w+) seconds=(\d+)"
MEMORY_KILL = (
    "(?i)beyond physical memory limits|Container killed by|OutOfMemoryError|GC overhead limit exceeded"
)
MEMORY_KILL_EXIT = 137
# Statuses that end a copy unit.
TERMINAL = ("COMPLETED", "FAILED", "SKIPPED", "EMPTY_SOURCE", "SOURCE_NOT_FOUND")
PASS_THROUGH = ("SOURCE_NOT_FOUND", "EMPTY_SOURCE", "SKIPPED")


def sync_plan(source: DataFrame, dest: DataFrame, keys: list[str] | None = None, path: str = "rel_path",
              size: str = "length", delete: bool = False) -> DataFrame:
    """COPY new or changed files (size differs), SKIP equal ones; extra ones are DELETEd or KEPT.

    ``bytes`` is what the action moves or removes.
    """
    keys = [*(keys or []), path]
    left = source.select(*keys, F.col(size).alias("source_size"))
    right = dest.select(*keys, F.col(size).alias("dest_size"))
    action = (
        F.when(F.col("source_size").isNull(), F.lit("DELETE" if delete else "KEEP"))
        .when(F.col("dest_size").isNull() | (F.col("source_size") != F.col("dest_size")), F.lit("COPY"))
        .otherwise(F.lit("SKIP"))
    )
    moved = (
        F.when(F.col("action") == "COPY", F.col("source_size"))
        .when(F.col("action") == "DELETE", F.col("dest_size"))
        .otherwise(F.lit(0))
    )
    return (
        left.join(right, keys, "full_outer")
        .withColumn("action", action)
        .withColumn("bytes", moved.cast("bigint"))
    )


def transferred(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Bytes and files added by a copy, and whether the destination already had files."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.col("file_count").alias(f"files_{name}"),
                         F.col("size_bytes").alias(f"bytes_{name}"))

    both = side(before, "before").join(side(after, "after"), keys, "full_outer")
    for c in ("files_before", "bytes_before", "files_after", "bytes_after"):
        both = both.withColumn(c, F.coalesce(c, F.lit(0)))
    return (
        both.withColumn("files_transferred", F.col("files_after") - F.col("files_before"))
        .withColumn("bytes_transferred", F.col("bytes_after") - F.col("bytes_before"))
        .withColumn("is_incremental", F.col("files_before") > 0)
    )


def with_cost(tables: DataFrame, out: str = "cost", mbps=metrics.COST_MBPS) -> DataFrame:
    """Estimated copy seconds of table volumes.

    Needs size_bytes, file_count, filter_active, filtered_bytes, filtered_files, selected_paths,
    nonempty_paths and failed.
    """
    size = metrics.effective("filter_active", "filtered_bytes", "size_bytes")
    files = metrics.effective("filter_active", "filtered_files", "file_count")
    cost = metrics.copy_seconds(size, files, "selected_paths", "nonempty_paths", "filter_active", "failed", mbps)
    return tables.withColumn(out, cost)


def resolve_cap(tables: DataFrame, lanes: int, backstop_seconds: float, cost: str = "cost") -> DataFrame:
    """One-row frame with the batch cap of a plan."""
    return tables.agg(F.sum(cost).alias("total_cost")).select(
        "total_cost", metrics.batch_cap(F.coalesce("total_cost", F.lit(0.0)), lanes, backstop_seconds).alias("cap"))


#: Tables that one task packs; a database with more is packed by several.
SHARD_TABLES = 50_000


def pack_batches(tables: DataFrame, cap: float, max_tables: int = 25, group: str = "db", name: str = "tbl",
                 cost: str = "cost", shards: int | None = None, shard_tables: int = SHARD_TABLES) -> DataFrame:
    """Add ``batch`` (text id), ``batch_cost`` and ``batch_rank`` (0 = most expensive).

    First-fit-decreasing within each of a database's shards of about ``shard_tables`` tables (or ``shards`` of them,
    whatever its size), cut by a hash of the table name; a task takes a shard at a time, a row of name and cost per table. The batches that shards leave half empty, one
    a shard at most, are then packed once more. A table above the cap gets its own batch; none is dropped.
    """
    slim = tables.select(F.col(group).cast("string").alias(group), F.col(name).cast("string").alias(name),
                         F.col(cost).cast("double").alias(cost), F.lit(1).cast("bigint").alias("_tables"))
    enough = F.ceil(F.count("*") / F.lit(shard_tables)) if shards is None else F.max(F.lit(shards)).cast("bigint")
    sizes = slim.groupBy(group).agg(enough.alias("_shards"))
    sharded = ordered.salted_join(slim, sizes, [group]).withColumn(
        "_shard", F.pmod(F.xxhash64(F.col(name)), "_shards")).drop("_shards")
    batch = F.concat_ws("/", group, F.col("_shard").cast("string"), F.col("_bin").cast("string"))
    packed = _packed(sharded, cap, max_tables, group, name, cost).select(group, name, cost, "_shard", batch.alias("batch"))
    members = materialize(packed, "pack-out")
    batches = members.groupBy(group, "_shard", "batch").agg(
        F.sum(cost).alias("batch_cost"), F.count(F.lit(1)).alias("batch_tables"))
    batches = materialize(batches, "pack-batches")
    merged = materialize(_merged(batches, cap, max_tables, group), "pack-merged")
    several = batches.join(merged, "batch", "left").withColumn("_to", F.coalesce("_to", "batch"))
    final = several.groupBy("_to").agg(F.sum("batch_cost").alias("batch_cost"), F.sum("batch_tables").alias("batch_tables"))
    ranked = rank_batches(final.withColumnRenamed("_to", "batch"), cap)
    members = members.join(merged, "batch", "left").withColumn("batch", F.coalesce("_to", "batch")).drop("_to", "_shard")
    return members.join(ranked, "batch")


def _merged(batches: DataFrame, cap: float, max_tables: int, group: str) -> DataFrame:
    """(batch, _to): batches at most half full in cost and number go together, under the first one's name.

    First fit opens a batch only if no open one has room, so a shard has one such batch at most.
    """
    half = batches.where((F.col("batch_cost") <= cap / 2) & (F.col("batch_tables") <= max_tables / 2))
    shards = half.groupBy(group).agg(F.count("*").alias("_n")).where("_n > 1").select(group)
    loose = half.join(shards, group).select(
        group, F.col("batch").alias("_item"), F.col("batch_cost").alias("_cost"), F.col("batch_tables").alias("_tables"),
        F.lit(0).cast("bigint").alias("_shard"))
    placed = _packed(loose, cap, max_tables, group, "_item", "_cost")
    heads = placed.groupBy(group, "_bin").agg(F.min("_item").alias("_to"))
    return placed.join(heads, [group, "_bin"]).select(F.col("_item").alias("batch"), "_to")


def _packed(sharded: DataFrame, cap: float, max_tables: int, group: str, name: str, cost: str) -> DataFrame:
    """(group, name, cost, _shard, _bin) of rows with ``_shard`` and ``_tables``, each shard packed by one task."""
    def bins_of(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        costs, counts = pdf[cost].to_numpy(dtype=float), pdf["_tables"].to_numpy()
        pieces = [slice(i, j) for i, j in zip(starts, [*starts[1:], len(pdf)])]
        return pdf.assign(_bin=np.concatenate([first_fit(costs[p], cap, max_tables, counts[p]) for p in pieces])).drop(
            columns="_tables")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_shard = None  # the last shard of a batch may go on in the next one
        for pdf in batches:
            if open_shard is not None:
                pdf = pd.concat([open_shard, pdf], ignore_index=True)
            if pdf.empty:
                continue
            new = pdf[group].ne(pdf[group].shift()) | pdf["_shard"].ne(pdf["_shard"].shift())
            starts = np.flatnonzero(new.to_numpy())
            open_shard = pdf.iloc[starts[-1]:]
            if starts[-1] > 0:
                yield bins_of(pdf.iloc[:starts[-1]], starts[:-1])
        if open_shard is not None:
            yield bins_of(open_shard, np.array([0]))

    # Whole shards meet in one task each, sorted by Spark; a task keeps one shard at a time.
    ready = sharded.repartition(group, "_shard").sortWithinPartitions(group, "_shard", F.col(cost).desc(), name)
    return ready.select(group, name, cost, "_shard", "_tables").mapInPandas(
        pack, f"`{group}` string, `{name}` string, `{cost}` double, _shard bigint, _bin bigint")


def first_fit(costs: np.ndarray, cap: float, max_items: int, counts: np.ndarray | None = None) -> np.ndarray:
    """Bin number per item, items in the order given: the first bin with room, else a new one.

    A tree over the bins holds the most room below each node, so an item finds its bin in the logarithm of their number.
    Bins that are not open yet have all their room. An item may stand for several (``counts``).
    """
    size = 1 << max(len(costs) - 1, 0).bit_length()
    most, room = [cap] * (2 * size), [cap] * size
    free, used = [max_items] * size, 0
    bins = np.empty(len(costs), dtype=np.int64)
    numbers = [1] * len(costs) if counts is None else counts.tolist()
    same = counts is None or bool((counts == 1).all())
    for i, (need, number) in enumerate(zip(costs.tolist(), numbers)):
        j = _first_with_room(most, size, need)
        while not same and j < used and free[j] < number:  # room for the cost, but not for so many
            j = _next_with_room(room, j + 1, used, need)
        if need > cap:
            j = used  # a batch of its own
        used = max(used, j + 1)
        room[j] -= need
        free[j] -= number
        bins[i] = j
        node = size + j
        most[node] = room[j] if free[j] > 0 else -np.inf
        while node > 1:
            node //= 2
            most[node] = max(most[2 * node], most[2 * node + 1])
    return bins


def _first_with_room(most: list[float], size: int, need: float) -> int:
    node = 1
    while node < size:
        node = 2 * node if most[2 * node] >= need else 2 * node + 1
    return node - size


def _next_with_room(room: list[float], start: int, used: int, need: float) -> int:
    return next((j for j in range(start, used) if room[j] >= need), used)


def rank_batches(batches: DataFrame, cap: float, steps: int = 4096) -> DataFrame:
    """Number batches from the most expensive, ties in an arbitrary but fixed order.

    Cost levels, then equal costs, then hash ranges of the names, so that many batches of one cost
    are numbered by many tasks.
    """
    level = F.least(F.lit(steps), F.floor(F.col("batch_cost") / F.lit(max(cap, 1e-9)) * F.lit(steps)))
    key = F.xxhash64("batch")
    bins = [F.lit(steps) - level, -F.col("batch_cost"), F.shiftright(key, 56)]
    return ordered.number_rows(batches, bins, [F.col("batch_cost").desc(), key, F.col("batch")], "batch_rank")


def batch_members(batch_keys: DataFrame, tables: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(table rows of the batch keys, keys no table row answers to)."""
    return batch_keys.join(tables, keys), batch_keys.join(tables.select(*keys), keys, "left_anti")


def split_folders(files: DataFrame, depth: int = 1, max_units: int = 1000, max_loose: int = 200,
                  root: str = "root", path: str = "rel_path", size: str = "length") -> DataFrame:
    """Copy units of each root: its folders ``depth`` levels down, and the loose files above them.

    A root without subfolders stays whole. ``over_limit`` marks the units of roots with more units, or more loose files
    in one folder, than asked for; they are kept all the same. ``rel_path`` is relative to the root.
    """
    pieces = F.split(F.col(path), "/")
    level = F.least(F.lit(depth), F.size(pieces) - 1)
    unit = F.array_join(F.slice(pieces, F.lit(1), level), "/")
    role = F.when(F.size(pieces) - 1 < depth, F.lit("loose_files")).otherwise(F.lit("subfolder"))
    units = (
        files.select(root, unit.alias("unit"), role.alias("role"), F.col(size).alias("_size"))
        .groupBy(root, "unit", "role")
        .agg(F.count(F.lit(1)).alias("file_count"), F.sum("_size").alias("size_bytes"))
    )
    units = materialize(units, "units")  # a row per folder, read several times below
    if depth > 1:
        # Files in a folder that has no subfolders are that folder, not loose.
        parents = units.where(F.col("unit") != "").select(
            root, F.explode(ancestors("unit")).alias("unit")).distinct().withColumn("_parent", F.lit(True))
        units = units.join(parents, [root, "unit"], "left")
        leaf = (F.col("role") == "loose_files") & (F.col("unit") != "") & F.col("_parent").isNull()
        units = units.withColumn("role", F.when(leaf, F.lit("subfolder")).otherwise(F.col("role"))).drop("_parent")
    loose = F.col("role") == "loose_files"
    safety = units.groupBy(root).agg(
        F.count(F.lit(1)).alias("_units"),
        F.count_if(~loose).alias("_folders"),
        F.max(F.when(loose, F.col("file_count"))).alias("_loose"),
        F.sum("file_count").alias("_files"),
        F.sum("size_bytes").alias("_bytes"),
    )
    whole = F.col("_folders") == 0
    over = (F.col("_units") > max_units) | (F.coalesce("_loose", F.lit(0)) > max_loose)
    kept = units.join(safety.where(~whole).select(root, over.alias("over_limit")), root)
    wholes = safety.where(whole).select(
        root, F.lit("").alias("unit"), F.lit("whole").alias("role"),
        F.col("_files").alias("file_count"), F.col("_bytes").alias("size_bytes"), over.alias("over_limit"))
    return kept.select(root, "unit", "role", "file_count", "size_bytes", "over_limit").unionByName(wholes)


def unit_outcome(error, source_exists, source_files, partitions_selected=None, copied_ok=None) -> Column:
    """Status of one copy unit from what was found and whether the copy ended well."""
    failed = F.coalesce(col(error), F.lit("")) != ""
    out = (
        F.when(~F.coalesce(col(source_exists), F.lit(True)), F.lit("SOURCE_NOT_FOUND"))
        .when(failed, F.lit("FAILED"))
    )
    if partitions_selected is not None:
        out = out.when(F.coalesce(col(partitions_selected), F.lit(1)) == 0, F.lit("SKIPPED"))
    out = out.when(F.coalesce(col(source_files), F.lit(0)) == 0, F.lit("EMPTY_SOURCE"))
    if copied_ok is not None:
        out = out.when(~F.coalesce(col(copied_ok), F.lit(False)), F.lit("FAILED"))
    return out.otherwise(F.lit("COMPLETED"))


def folder_validation(copy_status, dest_exists, source_files, dest_files, source_bytes, dest_bytes) -> Column:
    """Status after recounting a copied folder; statuses without a copy pass through."""
    status = col(copy_status)
    same = (col(source_files) == col(dest_files)) & metrics.size_matches(source_bytes, dest_bytes)
    ok = F.coalesce(col(dest_exists) & same, F.lit(False))
    return (
        F.when(status == "FAILED", F.lit("VALIDATION_SKIPPED"))
        .when(status.isin(*PASS_THROUGH), status)
        .when(ok, F.lit("VALIDATED"))
        .otherwise(F.lit("VALIDATION_FAILED"))
    )


def checkpoint_key(df: DataFrame, fields: list[str], out: str = "checkpoint_key") -> DataFrame:
    return df.withColumn(out, identity(*fields))


def resume(units: DataFrame, checkpoints: DataFrame, key: str = "checkpoint_key") -> tuple[DataFrame, DataFrame]:
    """(units still to do, latest terminal checkpoints to reuse).

    Only a unit whose latest attempt ended in a terminal status other than FAILED is done.
    """
    last = ordered.latest(checkpoints, [key], [F.col("attempt")])
    done = last.where(F.col("status").isin(*TERMINAL) & (F.col("status") != "FAILED"))
    todo = units.join(done.select(key), key, "left_anti")
    return todo, done.join(units.select(key), key, "left_semi")


def log_lines(logs: DataFrame, unit: str, text: str) -> DataFrame:
    """Log texts as (unit, line_no, line)."""
    return logs.select(unit, F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "line"))


def phase_times(lines: DataFrame, unit: str) -> DataFrame:
    """One row per unit and phase that started or ended: last start line, whether it ended, seconds."""
    start, end = F.regexp_extract("line", PHASE_START, 1), F.regexp_extract("line", PHASE_END, 1)
    marks = lines.where(F.col("line").rlike("^PHASE_(START|END) ")).select(
        unit, "line_no",
        F.when(start != "", start).otherwise(end).alias("phase"),
        (start != "").alias("is_start"),
        F.regexp_extract("line", PHASE_END, 2).try_cast("bigint").alias("seconds"),
    ).where(F.col("phase") != "")
    return marks.groupBy(unit, "phase").agg(
        F.max(F.when(F.col("is_start"), F.col("line_no"))).alias("start_line"),
        F.max(~F.col("is_start")).alias("ended"),
        F.max_by("seconds", F.when(~F.col("is_start"), F.col("line_no"))).alias("seconds"),
    )


def open_phases(lines: DataFrame, unit: str) -> DataFrame:
    """The last phase of each unit that started and never ended."""
    pending = phase_times(lines, unit).where(F.col("start_line").isNotNull() & ~F.col("ended"))
    return pending.groupBy(unit).agg(F.max_by("phase", "start_line").alias("open_phase"))


def diagnose(lines: DataFrame, units: DataFrame, unit: str) -> DataFrame:
    """Where each unit stopped and why, from its log lines.

    ``units`` has the unit and ``exit_code`` (NULL when the session was lost). One aggregate over
    the lines; a unit's log is never put together again.
    """
    def value(key: str) -> Column:
        pattern = rf"^{key}=(.*?)\s*$"
        found = F.when(F.col("line").rlike(pattern), F.trim(F.regexp_extract("line", pattern, 1)))
        return F.min_by(found, F.when(found.isNotNull(), F.col("line_no")))

    app = F.regexp_extract_all(F.col("line"), F.lit(r"(application_\d+_\d+)"), 1)
    facts = lines.groupBy(unit).agg(
        value("DISTCP_EXIT_CODE").try_cast("int").alias("copy_exit_code"),
        F.max(F.col("line").rlike(MEMORY_KILL)).alias("_killed"),
        F.max_by(F.try_element_at(app, F.lit(-1)), F.when(F.size(app) > 0, F.col("line_no"))).alias("application_id"),
        value("EDGE_HOST").alias("edge_host"),
    )
    ended = phase_times(lines, unit).groupBy(unit).agg(F.max("ended").alias("_some_ended"))
    out = units.join(facts, unit, "left").join(open_phases(lines, unit), unit, "left").join(ended, unit, "left")
    exit_code, copy_exit = F.col("exit_code"), F.col("copy_exit_code")
    phase = (
        F.when(F.col("open_phase").isNotNull(), F.col("open_phase"))
        .when(copy_exit != 0, F.lit("distcp"))
        .when(exit_code != 0, F.lit("script"))
        .when(exit_code.isNull() & F.coalesce("_some_ended", F.lit(False)), F.lit("after_script"))
        .when(exit_code.isNull(), F.lit("ssh_or_startup"))
    )
    killed = (
        F.coalesce("_killed", F.lit(False))
        | F.coalesce(exit_code == MEMORY_KILL_EXIT, F.lit(False))
        | F.coalesce(copy_exit == MEMORY_KILL_EXIT, F.lit(False))
    )
    return out.select(
        unit, "exit_code", "copy_exit_code", phase.alias("failure_phase"),
        F.col("application_id").isNotNull().alias("submitted"), "application_id",
        killed.alias("memory_kill_suspected"), "edge_host",
    )


def copy_metrics(lines: DataFrame, unit: str, names: list[str]) -> DataFrame:
    """``NAME=number`` metrics of each unit, last mention counting; absent or unreadable ones are 0."""
    pair = lines.select(
        unit, "line_no",
        F.regexp_extract("line", r"^\s*(\w+)\s*=", 1).alias("name"),
        F.trim(F.regexp_extract("line", r"^\s*\w+\s*=(.*)$", 1)).try_cast("bigint").alias("value"),
    ).where(F.col("name").isin(*names) & F.col("value").isNotNull())
    picks = [
        F.coalesce(F.max_by("value", F.when(F.col("name") == n, F.col("line_no"))), F.lit(0)).alias(n.lower())
        for n in names
    ]
    found = pair.groupBy(unit).agg(*picks)
    units = lines.select(unit).distinct()
    out = units.join(found, unit, "left")
    return out.select(unit, *[F.coalesce(n.lower(), F.lit(0)).alias(n.lower()) for n in names])
