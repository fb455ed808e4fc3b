"""Partition lists: parsing specs, selecting with the filter language, comparing, restricting.

A partition list is a frame with table keys (``db``, ``tbl`` unless told otherwise) and ``spec``, a
path-like text ``k=v/k=v``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import bind_once, col
from ..functions.text import glob_regex
from . import ordered

TABLE_KEYS = ("db", "tbl")
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
_LAST_N = re.compile(r"last_n_partitions\s*=\s*(\d+)", re.I)
_COMPARISON = re.compile(r"(\w+)\s*(>=|<=|!=|=|>|<)\s*(?:'([^']*)'|(\S+))")


class FilterError(ValueError):
    """A filter term that cannot be read."""


def decode_value(c) -> Column:
    """URL-decoded partition value; a plus sign stays, a broken escape is left as written."""
    def decoded(v: Column) -> Column:
        plain = F.coalesce(F.try_url_decode(F.replace(v, F.lit("+"), F.lit("%2B"))), v)
        return F.when(v.contains("%"), plain).otherwise(v)

    return bind_once(col(c), decoded)


def spec_entries(spec) -> Column:
    """Spec as ARRAY<STRUCT<k, v>> with decoded values; segments without ``=`` are skipped."""
    segments = F.filter(F.split(col(spec), "/"), lambda x: x.contains("="))

    def entry(segment: Column) -> Column:
        key = F.substring_index(segment, "=", 1)
        raw = F.substring(segment, F.length(key) + 2, F.length(segment))
        bare = F.regexp_replace(F.trim(raw), "^['\"]+|['\"]+$", "")
        return F.struct(F.trim(key).alias("k"), decode_value(bare).alias("v"))

    return F.transform(segments, entry)


def spec_map(spec) -> Column:
    """Spec as MAP<STRING, STRING>; of a key given twice the last value stands."""
    entries = spec_entries(spec)
    names = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: _last(entries, n)))


def _last(entries: Column, name: Column) -> Column:
    return F.try_element_at(F.filter(entries, lambda e: e["k"] == name), F.lit(-1))["v"]


def spec_value(spec, name: str) -> Column:
    """Value of one partition key, NULL when the spec lacks it; of a key given twice the last one."""
    mine = F.filter(F.split(col(spec), "/"), lambda x: x.contains("=") & (F.trim(F.substring_index(x, "=", 1)) == name))
    raw = F.regexp_replace(F.try_element_at(mine, F.lit(-1)), "^[^=]*=", "")
    return decode_value(F.btrim(F.trim(raw), F.lit("'\"")))


# The directory name of a missing value, and the characters Spark escapes in directory names.
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = r"""[\x01-\x1F\x7F"#%'*/:=?\\{\[\]^]"""


def escape_value(value: Column) -> Column:
    """A partition value as Spark writes it in directory names."""
    def escaped(v: Column) -> Column:
        one = F.transform(F.split(v, ""), lambda c: F.when(c.rlike(_ESCAPED), F.concat(F.lit("%"), F.lpad(F.hex(c), 2, "0")))
                          .otherwise(c))
        return F.when(v.rlike(_ESCAPED), F.array_join(one, "")).otherwise(v)

    return F.coalesce(bind_once(F.nullif(value, F.lit("")), escaped), F.lit(DEFAULT_PARTITION))


def make_spec(*names: str) -> Column:
    """Spec text from partition columns, as Spark names the directories."""
    return F.concat_ws("/", *[F.concat(F.lit(f"{n}="), escape_value(F.col(n).cast("string"))) for n in names])


@dataclass(frozen=True)
class Term:
    """One comma-separated term: kind is ``last``, ``glob`` or ``where``."""

    kind: str
    text: str
    count: int = 0


def parse_filter(expression: str | None, strict: bool = True) -> list[Term]:
    """Terms of a filter expression. Unreadable terms raise, or are dropped when not strict."""
    terms = []
    for text in (t.strip() for t in (expression or "").split(",")):
        if not text:
            continue
        try:
            terms.append(_parse_term(text))
        except FilterError:
            if strict:
                raise
    return terms


def _parse_term(text: str) -> Term:
    last = _LAST_N.fullmatch(text)
    if last:
        return Term("last", text, int(last.group(1)))
    wild = re.search(r"[*?]", text) is not None
    logic = re.search(r"\b(AND|OR)\b", text, re.I) is not None
    if wild and logic:
        raise FilterError(f"a term is either a glob or a condition: {text!r}")
    if wild:
        return Term("glob", text)
    _condition(text, lambda name, op, literal: F.lit(True))
    return Term("where", text)


def _condition(text: str, compare) -> Column:
    """Boolean column of a condition. OR binds weakest; ``a=1/b=2`` reads as ``a=1 AND b=2``."""
    def split(pattern: str, part: str) -> list[str]:
        return [p.strip() for p in re.split(pattern, part, flags=re.I)]

    any_of = None
    for choice in split(r"\bOR\b", text):
        all_of = None
        for clause in split(r"\bAND\b", choice):
            for piece in re.split(r"/(?=(?:[^']*'[^']*')*[^']*$)", clause):
                match = _COMPARISON.fullmatch(piece.strip().strip("()").strip())
                if not match:
                    raise FilterError(f"cannot read {piece.strip()!r} in the filter term {text!r}")
                name, op, in_quotes, bare = match.groups()
                test = compare(name, op, bare if in_quotes is None else in_quotes)
                all_of = test if all_of is None else all_of & test
        any_of = all_of if any_of is None else any_of | all_of
    return any_of


def compare_value(value: Column, op: str, literal: str) -> Column:
    """As numbers when both sides are numbers, else as text; a missing value compares false."""
    tests = {
        "=": lambda a, b: a == b, "!=": lambda a, b: a != b,
        ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
        "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    }
    if not re.match(_NUMBER, literal):
        return F.coalesce(tests[op](value, F.lit(literal)), F.lit(False))

    def compare(v: Column) -> Column:
        as_number = tests[op](F.trim(v).try_cast("double"), F.lit(float(literal)))
        return F.when(v.rlike(_NUMBER), as_number).otherwise(tests[op](v, F.lit(literal)))

    return F.coalesce(bind_once(value, compare), F.lit(False))


def term_predicate(term: Term, spec: Column | str = "spec") -> Column:
    if term.kind == "glob":
        return F.rlike(col(spec), glob_regex(F.lit(term.text)))
    return _condition(term.text, lambda name, op, literal: compare_value(spec_value(spec, name), op, literal))


def select_partitions(partitions: DataFrame, expression: str | None, keys=TABLE_KEYS,
                      order_by: str = "spec", strict: bool = True) -> DataFrame:
    """Partitions that match any term of the filter, each once; all of them for an empty filter.

    ``last_n_partitions`` counts per table from the end of ``order_by``. Row conditions stay one
    narrow filter; only a last-n term adds a (salted) top-n.
    """
    terms = parse_filter(expression, strict)
    if not (expression or "").strip():
        return partitions
    hit = F.lit(False)
    for term in terms:
        if term.kind != "last":
            hit = hit | term_predicate(term)
    last = max((t.count for t in terms if t.kind == "last"), default=0)
    if not last:
        return partitions.where(hit)
    keys = list(keys)
    order = [F.col(order_by).desc(), F.col("spec").desc()]
    named = list(dict.fromkeys([*keys, "spec", order_by]))
    distinct = partitions.select(*named).distinct()
    chosen = ordered.top_n(distinct, keys, order, last)
    if len(terms) > sum(t.kind == "last" for t in terms):
        chosen = chosen.unionByName(distinct.where(hit)).distinct()
    if set(named) == set(partitions.columns):
        return chosen.select(*partitions.columns)
    return partitions.join(chosen.select(*keys, "spec").distinct(), [*keys, "spec"], "left_semi")


def typed_values(partitions: DataFrame, kinds: dict[str, T.DataType]) -> DataFrame:
    """The specs' values as columns of these types; the default partition's value is NULL.

    Specs with a value that its type cannot hold are left out.
    """
    read, sound = {}, F.lit(True)
    for name, kind in kinds.items():
        value = F.nullif(spec_value("spec", name), F.lit(DEFAULT_PARTITION))
        read[name] = value.try_cast(kind)
        sound = sound & (read[name].isNotNull() == value.isNotNull()) & spec_value("spec", name).isNotNull()
    return partitions.where(sound).withColumns(read)


def restrict(df: DataFrame, partitions: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``df`` in the listed partitions; an empty list gives no rows.

    A left semi join on the partition columns in their own types, so file-based tables are pruned
    at run time and a repeated spec changes nothing. Rows of default partitions (a NULL among the
    columns) are met apart, null-safe, so that the join of all others stays one Spark can prune.
    """
    wanted = typed_values(partitions, {c: df.schema[c].dataType for c in columns}).select(*columns).distinct()
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    some = df.where(missing).alias("l").join(
        wanted.where(missing).alias("r"), same_values("l", "r", columns), "left_semi")
    return df.join(wanted, columns, "left_semi").unionByName(some)


def same_values(left: str, right: str, columns: list[str]) -> Column:
    """Null-safe equality of columns of two aliased frames."""
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`"))
    return same


def specs_predicate(specs: list[str]) -> Column:
    """OR of ANDs over the partition columns for a short list known to the driver; false if empty."""
    any_of = F.lit(False)
    for spec in specs:
        all_of = F.lit(True)
        for segment in spec.strip().split("/"):
            name, eq, value = segment.partition("=")
            if eq:
                all_of = all_of & (F.col(name.strip()) == decode_value(F.lit(value.strip())))
        any_of = any_of | all_of
    return any_of


def partition_counts(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Rows per partition, with its spec."""
    keys = keys or []
    counts = df.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumn("spec", make_spec(*columns))


def nonempty_partitions(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Number of partitions that hold rows, per table."""
    keys = keys or []
    return df.select(*keys, *columns).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("partition_count"))


def compare_partitions(registered: DataFrame, actual: DataFrame, keys=TABLE_KEYS) -> DataFrame:
    """Registered against actual specs: MATCH, EMPTY (registered, no data), UNREGISTERED, or PADDING
    when the only difference is leading zeros of the values.

    ``padded_as`` names the other side's spelling.
    """
    keys = list(keys)
    left = registered.select(*keys, "spec").distinct().withColumn("_r", F.lit(True))
    right = actual.select(*keys, "spec").distinct().withColumn("_a", F.lit(True))
    both = left.join(right, [*keys, "spec"], "full_outer").withColumn("bare", strip_zeros("spec"))
    odd = both.where(F.col("_r").isNull() | F.col("_a").isNull())
    forms = odd.groupBy(*keys, "bare").agg(
        F.min(F.when(F.col("_r"), F.col("spec"))).alias("_registered_as"),
        F.min(F.when(F.col("_a"), F.col("spec"))).alias("_actual_as"),
    )
    joined = both.join(forms, [*keys, "bare"], "left")
    other = F.when(F.col("_r").isNull(), F.col("_registered_as")).otherwise(F.col("_actual_as"))
    state = (
        F.when(F.col("_r") & F.col("_a"), F.lit("MATCH"))
        .when(other.isNotNull(), F.lit("PADDING"))
        .when(F.col("_a").isNull(), F.lit("EMPTY"))
        .otherwise(F.lit("UNREGISTERED"))
    )
    is_match = F.coalesce(F.col("_r") & F.col("_a"), F.lit(False))
    return joined.select(*keys, "spec", state.alias("state"), F.when(~is_match, other).alias("padded_as"))


def strip_zeros(spec) -> Column:
    """Spec with leading zeros of all-digit values removed."""
    return F.regexp_replace(col(spec), r"=0+(?=\d+(/|$))", "=")


PARTITION_SCHEMA = T.StructType([
    T.StructField("db", T.StringType()),
    T.StructField("tbl", T.StringType()),
    T.StructField("spec", T.StringType()),
])
