"""Identity keys, null-safe slice keys, durations, bounded JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .paths import col


def identity(*fields) -> Column:
    """sha256 of the fields as a compact JSON array; NULL and 'null' stay apart."""
    return F.sha2(F.to_json(F.array(*[col(f).cast("string") for f in fields])), 256)


def slice_key(partition_filter) -> Column:
    """A missing filter and an empty one name the same slice."""
    return F.coalesce(col(partition_filter), F.lit(""))


def seconds_between(start, end) -> Column:
    """Seconds between two UTC timestamps (text ``yyyy-MM-dd HH:mm:ss`` or timestamps); NULL if unreadable."""
    def epoch(c):
        return col(c).try_cast("timestamp").cast("double")

    return epoch(end) - epoch(start)


def utc_text(ts) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd HH:mm:ss")


def bounded_json(record: Column, long_field: str, limit: int = 4000) -> Column:
    """JSON of a struct that always parses, within ``limit`` characters if shortening one field can do it.

    The field that can grow is shortened, then left empty; all other fields are always there.
    """
    def render(value: Column) -> Column:
        return F.to_json(record.withField(long_field, value), {"ignoreNullFields": "false"})

    whole = F.to_json(record, {"ignoreNullFields": "false"})
    text = F.coalesce(record[long_field], F.lit(""))
    keep = F.length(text) - (F.length(whole) - F.lit(limit)) - F.lit(3)
    shorter = render(F.when(keep > 0, F.concat(F.substring(text, F.lit(1), keep), F.lit("..."))))
    without = render(F.lit(None).cast("string"))
    return F.when(F.length(whole) <= limit, whole).when(F.length(shorter) <= limit, shorter).otherwise(without)


def json_pieces(record: Column, long_field: str, limit: int = 4000) -> Column:
    """A struct as an array of JSON texts of at most about ``limit`` characters, nothing left out.

    Each piece has all fields; of the one that can grow it has the next characters, and ``piece`` and ``pieces`` say which.
    """
    text = F.coalesce(record[long_field], F.lit(""))
    pieces = F.greatest(F.ceil(F.length(text) / F.lit(limit)), F.lit(1)).cast("int")

    def piece(i: Column) -> Column:
        part = F.when(record[long_field].isNotNull(), F.substring(text, i * limit + 1, F.lit(limit)))
        whole = record.withField(long_field, part).withField("piece", i).withField("pieces", pieces)
        return F.to_json(whole, {"ignoreNullFields": "false"})

    return F.transform(F.sequence(F.lit(0), pieces - 1), piece)
