"""What the text operators share: word and line rules, Arrow helpers, whole rows carried as one struct."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.session import small_batches

#: White space of the contracts: space and the control characters tab to carriage return, nothing of Unicode.
BLANKS = b" \t\n\x0b\x0c\r"
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
WORD_SQL = r"[\x20\x09-\x0D]+"


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, row): the input's columns as the struct ``row``, so that no name of theirs can clash."""
    small_batches(docs.sparkSession)
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"),
                       F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))


def with_text(frame: DataFrame, text: str, text_col: str, columns: list[str]) -> DataFrame:
    """The rows carried by ``keyed`` with ``text`` in place of their text."""
    return frame.select(*[F.col(text).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in columns])


def word_array(text: Column | str) -> Column:
    """Words of a text as an array, empty for null and blank texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SQL), lambda w: w != F.lit(""))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts of an Arrow column as bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def repeat_rows(column: pa.Array, counts: np.ndarray) -> pa.Array:
    """Each value of an Arrow column as often as ``counts`` says."""
    return column.take(pa.array(np.repeat(np.arange(len(counts)), counts)))
