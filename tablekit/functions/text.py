"""Text cells: blank-like values, lists, names, reasons, log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .paths import col

# Words a sheet uses for "no value", and for true and false.
BLANK_WORDS = ("", "nan", "null", "none")
TRUE_WORDS = ("true", "t", "1", "1.0", "yes", "y", "on")
FALSE_WORDS = ("false", "f", "0", "0.0", "no", "n", "off")
# Fixed value: what a grant without permissions means.
DEFAULT_PERMISSION = "read"


def blank_to_null(c) -> Column:
    """Trimmed text, or NULL for a cell that only looks filled."""
    text = F.trim(col(c).cast("string"))
    return F.when(~F.lower(text).isin(*BLANK_WORDS), text)


def boolean_word(c, default: bool | None = None) -> Column:
    """TRUE/FALSE for the known words, the default for a blank, NULL for anything else."""
    word = F.lower(F.trim(col(c).cast("string")))
    return (
        F.when(word.isin(*TRUE_WORDS), F.lit(True))
        .when(word.isin(*FALSE_WORDS), F.lit(False))
        .when(word.isNull() | word.isin(*BLANK_WORDS), F.lit(default).cast("boolean"))
    )


def bad_boolean_word(c) -> Column:
    """True when the cell holds a word that is neither a boolean nor a blank."""
    word = F.lower(F.trim(F.coalesce(col(c).cast("string"), F.lit(""))))
    return ~word.isin(*TRUE_WORDS, *FALSE_WORDS, *BLANK_WORDS)


def list_cell(c, sep: str = ",") -> Column:
    """Separated cell to an array of trimmed, non-blank entries; a blank cell gives an empty array."""
    parts = F.transform(F.split(F.coalesce(blank_to_null(c), F.lit("")), sep), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def permission_list(c) -> Column:
    """Permission cell to lower-case words; a blank cell means read."""
    words = F.transform(list_cell(c), lambda x: F.lower(x))
    return F.when(F.size(words) == 0, F.array(F.lit(DEFAULT_PERMISSION))).otherwise(words)


def policy_name(catalog, database, table, column) -> Column:
    """Dotted resource name without trailing wildcards; database ``*`` names the catalog only."""
    database, table, column = col(database), col(table), col(column)
    any_table = F.coalesce(table, F.lit("")).isin("", "*")
    any_column = F.coalesce(column, F.lit("")).isin("", "*")
    table_part = F.when(~any_table, table).when(~any_column, F.lit("*"))
    column_part = F.when(~any_column, column)
    return F.when(database == "*", col(catalog)).otherwise(
        F.concat_ws(".", col(catalog), database, table_part, column_part)
    )


def reason(code, detail) -> Column:
    """``[CODE] detail`` with runs of whitespace made single."""
    detail = F.trim(F.regexp_replace(col(detail).cast("string"), r"\s+", " "))
    return F.concat(F.lit("["), col(code), F.lit("] "), detail)


def reason_code(c) -> Column:
    """Code of a reason text, '' when there is none."""
    return F.regexp_extract(F.trim(F.coalesce(col(c), F.lit(""))), r"^\[([A-Z0-9_]+)\]", 1)


def reason_detail(c) -> Column:
    text = F.trim(F.coalesce(col(c), F.lit("")))
    return F.trim(F.regexp_replace(text, r"^\[[A-Z0-9_]+\]\s*", ""))


def application_ids(c) -> Column:
    """Cluster application ids in a log text, each once, in order of first mention."""
    return F.array_distinct(F.regexp_extract_all(col(c), F.lit(r"(application_\d+_\d+)"), 1))


def log_value(text, key: str) -> Column:
    """Value of the first ``KEY=value`` line of a log text, '' when absent."""
    return F.trim(F.regexp_extract(col(text), rf"(?m)^{key}=(.*?)\r?$", 1))


def mapping_name(role, principal, kind) -> Column:
    return F.concat(col(role), F.lit("->"), col(principal), F.lit(" ("), col(kind), F.lit(")"))


def mapping_role(c) -> Column:
    return F.trim(F.regexp_extract(col(c), r"^(.+?)->", 1))


def mapping_principal(c, kinds: str = "group|user") -> Column:
    return F.trim(F.regexp_extract(col(c), rf"->([^(]+)\s*\(({kinds})\)$", 1))


def glob_regex(c) -> Column:
    """Anchored regex of a glob in which ``*`` and ``?`` also cross slashes."""
    quoted = F.regexp_replace(col(c), r"([\\.\[\]{}()+^$|])", r"\\$1")
    body = F.regexp_replace(F.regexp_replace(quoted, r"\*", ".*"), r"\?", ".")
    return F.concat(F.lit("(?s)^"), body, F.lit("$"))


def preview(items: Column, total: Column, shown: int, sep: str = "; ") -> Column:
    """First entries as text, with ``(+k more)`` when the total is larger."""
    rest = total - F.lit(shown)
    head = F.array_join(F.slice(items, 1, shown), sep)
    return F.when(rest > 0, F.concat(head, F.lit(" (+"), rest.cast("string"), F.lit(" more)"))).otherwise(head)
