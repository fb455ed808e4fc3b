"""Joining rows with one row per key where a few keys hold much of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one row in SHARE is hot; there are fewer than SHARE of them, whatever the corpus.
SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows`` with the other columns of ``groups`` (one row per key, ``size`` rows of ``rows`` each).

    Null keys match each other. Hot keys are broadcast, fewer than SHARE narrow rows; the others are shuffled, none of
    them with more than one row in SHARE. Both frames are read more than once: give written ones. Every key of
    ``rows`` must be in ``groups``.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    named = groups.select(*[F.col(c).alias(f"group_{c}") if c in keys else F.col(c) for c in groups.columns])
    is_hot = F.col(size) * SHARE > F.lit(total)
    match = reduce(and_, [F.col(c).eqNullSafe(F.col(f"group_{c}")) for c in keys])
    hot = named.where(is_hot)
    held = [f"group_{c}" for c in keys]
    many = rows.join(F.broadcast(hot), match).drop(*held)
    few = rows.join(F.broadcast(hot.select(*held)), match, "left_anti").join(named.where(~is_hot), match).drop(*held)
    return many.unionByName(few)
