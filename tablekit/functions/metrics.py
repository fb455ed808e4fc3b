"""Copy arithmetic: sizes, cost estimates, rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .paths import col

MIB = 1024 * 1024
GIB = 1024 * MIB
# Weights of the copy-cost estimate and of the batch cap.
COST_MBPS = 150
COST_SECONDS_PER_JOB = 45
COST_SECONDS_PER_PATH_SCAN = 12
COST_BASE_SECONDS = 30
COST_SECONDS_PER_FILE = 0.002
COST_MKDIR_SECONDS_PER_PATH = 2
BUDGET_SLACK = 1.25
BATCH_BUDGET_FRACTION = 0.9
BATCHES_PER_LANE = 2
SIZE_TOLERANCE = 0.01


def effective(filter_active, filtered, total) -> Column:
    """The filtered total when a filter is active and was measured, else the whole; never NULL."""
    value = F.when(col(filter_active), F.coalesce(col(filtered), col(total))).otherwise(col(total))
    return F.coalesce(value, F.lit(0))


def size_matches(source, dest) -> Column:
    """Sizes within one percent of the source, and at least one byte of slack."""
    source, dest = col(source), col(dest)
    slack = F.greatest(F.lit(1), F.floor(source * F.lit(SIZE_TOLERANCE)).cast("bigint"))
    return F.abs(source - dest) <= slack


def copy_seconds(size_bytes, files, paths, jobs, filter_active, failed=None, mbps=COST_MBPS) -> Column:
    """Estimated seconds to copy one table.

    ``paths`` and ``jobs`` are the selected partitions and the non-empty ones among them; without an
    active filter both are one. ``mbps`` may be a column (a rate per table).
    """
    size_bytes, files, paths, jobs = col(size_bytes), col(files), col(paths), col(jobs)
    active = F.coalesce(col(filter_active), F.lit(False))
    paths = F.when(active, paths).otherwise(F.lit(1))
    jobs = F.when(active, jobs).otherwise(F.lit(1))
    rate = (mbps if isinstance(mbps, Column) else F.lit(mbps)) * F.lit(float(MIB))
    full = (
        F.lit(float(COST_BASE_SECONDS))
        + size_bytes / rate
        + jobs * F.lit(COST_SECONDS_PER_JOB)
        + paths * F.lit(2 * COST_SECONDS_PER_PATH_SCAN)
        + files * F.lit(COST_SECONDS_PER_FILE)
    )
    cost = (
        F.when(active & (paths == 0), F.lit(float(COST_BASE_SECONDS)))
        .when(files == 0, COST_BASE_SECONDS + paths * F.lit(float(COST_MKDIR_SECONDS_PER_PATH)))
        .otherwise(full)
    )
    if failed is None:
        return cost
    return F.when(F.coalesce(col(failed), F.lit(False)), F.lit(0.0)).otherwise(cost)


def budget_mbps(files_per_job, mappers: int, per_mapper_mbps: int) -> Column:
    """Rate a bandwidth budget allows: one mapper per file at most, never above the default rate."""
    lanes = F.least(F.lit(mappers), F.greatest(col(files_per_job), F.lit(1)))
    return F.least(F.lit(COST_MBPS), lanes * F.lit(per_mapper_mbps))


def batch_cap(total_cost, lanes: int, backstop_seconds: float) -> Column:
    """Largest batch that can still finish in time, or a fair share of the lanes if smaller."""
    ceiling = BATCH_BUDGET_FRACTION * backstop_seconds / BUDGET_SLACK
    if lanes <= 0:
        return F.lit(ceiling)
    return F.least(F.lit(ceiling), col(total_cost) / F.lit(lanes * BATCHES_PER_LANE))


def ratio(num, den) -> Column:
    """num / den, with a missing or zero denominator read as one."""
    den = col(den)
    return F.coalesce(col(num), F.lit(0)) / F.when(F.coalesce(den, F.lit(0)) == 0, F.lit(1)).otherwise(den)


def percent_difference(a, b) -> Column:
    """|a - b| in percent of a, zero when a is not positive."""
    a, b = col(a), col(b)
    return F.when(a > 0, F.abs(a - b) / a * 100).otherwise(F.lit(0.0))
