"""Line deduplication: explode normalised lines, hash, count documents per hash, drop, reassemble by position."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import BLANKS, keyed, repeat_rows, text_bytes
from tablekit.llm.hot_join import join_groups
from tablekit.session import materialize

#: A code point has at most four bytes in UTF-8.
_WIDEST = 4


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key; None for keys under ``min_chars`` code points, which are never dropped."""
    key = line.strip(BLANKS)
    if len(key) < min_chars or (len(key) < _WIDEST * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key.lower())  # bytes.lower() changes A-Z only


def _line_hashes(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = [], []
            for text in text_bytes(batch.column("text")):
                own = {line_hash(x, min_chars) for x in text.split(b"\n")} - {None}
                found.extend(own)
                counts.append(len(own))
            pair = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            own_rows = [repeat_rows(batch.column(c), np.array(counts, int)) for c in ("id", "own")]
            yield pa.RecordBatch.from_arrays([*own_rows, pa.array(pair[:, 0]), pa.array(pair[:, 1])],
                                             names=["id", "own", "h1", "h2"])
    return run


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Drop lines that at least ``min_docs`` documents hold, except in the smallest id that holds them.

    Returns (id, n_lines, n_dropped, kept, row), one row per input row; ``row`` is the input row as a struct.
    A null or empty text is one empty line. Rows with the same id are one document, each with its own text. Rows
    without id form one document that comes after all others; each loses the lines of its own text only. Line order is kept; a text of which every line goes
    is empty.
    """
    own = keyed(docs, id_col, text_col).withColumn("own", F.xxhash64("text"))  # rows that share an id stay apart
    id_type = own.schema["id"].dataType.simpleString()
    lines = materialize(own.select("id", "own", "text").mapInArrow(
        _line_hashes(min_chars), f"id {id_type}, own bigint, h1 bigint, h2 bigint"), "line-hashes")
    if min_docs <= 2:  # two documents differ in the smallest and largest id; no distinct count is needed
        groups = lines.groupBy("h1", "h2").agg(F.min("id").alias("keeper"), F.max("id").alias("last"), F.count("*").alias("rows"),
                                               F.max(F.col("id").isNull()).alias("nameless"))
        several = (F.col("keeper") < F.col("last")) | (F.col("nameless") & F.col("keeper").isNotNull())
        repeated = groups.where(several if min_docs == 2 else F.lit(True))
    else:
        repeated = (lines.groupBy("h1", "h2", "id").agg(F.count("*").alias("n")).groupBy("h1", "h2")
                    .agg(F.min("id").alias("keeper"), F.count("*").alias("holders"), F.sum("n").alias("rows"))
                    .where(F.col("holders") >= min_docs))
    repeated = materialize(repeated.select("h1", "h2", "keeper", "rows"), "line-keepers")
    drops = (join_groups(lines, repeated, ["h1", "h2"], "rows")
             .where(~F.col("id").eqNullSafe(F.col("keeper")))
             .groupBy("id", "own").agg(F.collect_set(F.struct("h1", "h2")).alias("found"))  # the lines of one text
             .select(F.col("id").alias("drop_id"), F.col("own").alias("drop_own"), F.col("found.h1").alias("d1"),
                     F.col("found.h2").alias("d2")))

    @F.pandas_udf("kept string, n_lines bigint, n_dropped bigint")
    def reassemble(text: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.DataFrame:
        kept, total, gone = [], [], []
        for value, a, b in zip(text, d1, d2, strict=True):
            parts = (value or "").split("\n")
            total.append(len(parts))
            if a is not None and len(a):
                drop = set(map(bytes, np.stack([np.asarray(a, "<i8"), np.asarray(b, "<i8")], 1)))
                parts = [x for x in parts if line_hash(x.encode(), min_chars) not in drop]
            gone.append(total[-1] - len(parts))
            kept.append("\n".join(parts))
        return pd.DataFrame({"kept": kept, "n_lines": total, "n_dropped": gone})

    joined = own.join(drops, F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("own") == F.col("drop_own")), "left")
    done = joined.select("id", "row", reassemble("text", "d1", "d2").alias("out"))
    return done.select("id", "out.n_lines", "out.n_dropped", "out.kept", "row")
