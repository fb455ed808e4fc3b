"""Filters of fixed size for sets of hashes of any size, made by Spark and sent to the tasks.

A filter may let hashes through that are not in the set, never the other way round, so what passes it is looked at
again and nothing is lost. The fuller it gets, the less it saves.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter (a power of two): 16 MB, whatever the corpus.
FILTER_BITS = 1 << 27
_SPARSE_BYTES = 12  # of a word sent with its number
_LOW = 20  # lowest bit of a hash that names its place


def filter_of(hashes: DataFrame) -> bytes:
    """The filter of the column ``h``. At most FILTER_BITS / 64 sums reach the driver.

    Each process that reads a broadcast keeps it on disk, so a filter with few words in use is sent as their numbers
    (4 bytes each) and the words.
    """
    place = F.shiftrightunsigned("h", _LOW).bitwiseAND(F.lit(FILTER_BITS - 1))
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {_LOW}) & 63 AS INT))")
    words = hashes.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    return pack_words(words.column("word").to_numpy(), words.column("bits").to_numpy())


def pack_words(at: np.ndarray, bits: np.ndarray) -> bytes:
    """The words ``bits`` of a filter at the places ``at``, in the shorter of both forms."""
    if len(at) * _SPARSE_BYTES < FILTER_BITS // 8:
        return at.astype(np.uint32).tobytes() + bits.astype(np.int64).tobytes()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[at] = bits
    return table.tobytes()


def repeated(hashes: DataFrame) -> DataFrame:
    """The values of ``h`` with more than one row."""
    return hashes.groupBy("h").count().where("count > 1").select("h")


def read_filter(data: bytes) -> np.ndarray:
    if len(data) == FILTER_BITS // 8:
        return np.frombuffer(data, np.uint64)
    n = len(data) // _SPARSE_BYTES
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    table[np.frombuffer(data, np.uint32, n)] = np.frombuffer(data[4 * n:], np.uint64)
    return table


def held(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes pass the filter."""
    place = (hashes >> np.uint64(_LOW)) & np.uint64(FILTER_BITS - 1)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
