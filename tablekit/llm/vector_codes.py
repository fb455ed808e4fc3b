"""Vector code compression: a vector becomes the indexes of the nearest codebook entries of its parts.

Codebooks are refined in rounds. A round is one pass over the vectors that adds up, inside each task, the parts of
every entry; what is shuffled are those sums. Nearest entries come from one GNAT tree per part position.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256
from math import floor, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.llm.gnat import Gnat
from tablekit.llm.hot_join import join_groups
from tablekit.session import materialize

PARTS = 16
ENTRIES = 64  # two hexadecimal digits name up to 256
ROUNDS = 2
SCALE = 256
_LONG = (1 << 63) - 1
_LIMB = 31  # bits of a piece of a sum: sums of pieces stay in 64 bits
_ROWS = 1 << 14  # queries at once

#: codebooks[part][entry][position]
Codebooks = list[list[list[int]]]


def _own(vectors: DataFrame, id_col: str, vector_col: str, *others: str) -> DataFrame:
    return vectors.select(vectors[id_col].alias("id"), vectors[vector_col].cast("array<double>").alias("vector"),
                          *[vectors[c].alias(a) for a, c in zip(("label",), others)])


def _kept():
    """Whether a vector counts: not null, no null or non-finite component."""
    return F.col("vector").isNotNull() & ~F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))


def _whole(x: float) -> int:
    return int(x) * SCALE if abs(x) >= 2.0 ** 53 else floor(x * SCALE)


def _integers(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The kept vectors as integer rows of ``width`` components, shorter ones filled up with zeros, and which are kept.

    Rows are 64-bit where squared distances fit, else Python integers.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)  # null components become NaN
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    kept = (bad[offsets[1:]] == bad[offsets[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(kept, offsets[1:] - offsets[:-1], 0)
    rows = np.repeat(np.arange(len(kept)), lengths)
    places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((len(kept), width))
    out[rows, places] = flat[np.repeat(offsets[:-1], lengths) + places]
    out = out[kept]
    if not out.size or np.abs(out).max() * SCALE < isqrt((1 << 61) // max(width // PARTS, 1)) // 2:
        return np.floor(out * SCALE).astype(np.int64), kept
    return np.array([[_whole(x) for x in row] for row in out.tolist()], object).reshape(out.shape), kept


def _table(entries: list[list[int]]) -> np.ndarray:
    size = max((abs(x) for e in entries for x in e), default=0)
    fits = size < isqrt((1 << 61) // max(len(entries[0]), 1)) // 2
    return np.array(entries, np.int64 if fits else object).reshape(len(entries), len(entries[0]))


def _assigned(trees: list[Gnat], vectors: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Per block of vectors: entries (rows x parts) and squared distances."""
    step = vectors.shape[1] // PARTS
    for start in range(0, len(vectors), _ROWS):
        block = slice(start, start + _ROWS)
        found = [t.nearest(vectors[block, p * step:(p + 1) * step]) for p, t in enumerate(trees)]
        yield block, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    sign, total, place = (-1 if total < 0 else 1), abs(total), 0
    while total:
        yield place, sign * (total & ((1 << _LIMB) - 1))
        total >>= _LIMB
        place += 1


def _sums(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, place, limb, total) of the parts nearest to each entry; place -1 counts them."""
    width = PARTS * len(books[0][0])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(_table(b)) for b in books]
        sums = [np.zeros((len(b), width // PARTS), object) for b in books]
        counts = np.zeros((PARTS, len(books[0])), np.int64)
        for batch in batches:
            vectors, _ = _integers(batch.column("vector"), width)
            for block, entries, _ in _assigned(trees, vectors):
                for p in range(PARTS):
                    part = vectors[block, p * (width // PARTS):(p + 1) * (width // PARTS)]
                    order = np.argsort(entries[:, p], kind="stable")
                    used, first = np.unique(entries[order, p], return_index=True)
                    sums[p][used] += np.add.reduceat(part[order], first, axis=0).astype(object)
                    counts[p] += np.bincount(entries[:, p], minlength=len(books[0]))
        out = [(p, e, i, k, v) for p in range(PARTS) for e in np.flatnonzero(counts[p]).tolist()
               for i, total in enumerate((int(counts[p][e]), *sums[p][e]), -1) for k, v in _limbs(int(total))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)],
            names=["part", "entry", "place", "limb", "total"])

    told = rows.select("vector").mapInArrow(add, "part long, entry long, place long, limb long, total long")
    return told.groupBy("part", "entry", "place", "limb").agg(F.sum("total").alias("total"))


def _refined(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round; at most (components + 1) x ENTRIES sums reach the driver."""
    totals = defaultdict(int)
    for part, entry, place, limb, total in _sums(rows, books).collect():
        totals[part, entry, place] += total << (_LIMB * limb)
    return [[[totals[p, e, i] // totals[p, e, -1] for i in range(len(old))] if totals[p, e, -1] else old
             for e, old in enumerate(book)] for p, book in enumerate(books)]


def train_codebooks(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Codebooks:
    """The codebooks of the kept vectors; no entries if none is kept.

    Rows whose vector is null or holds a null or non-finite component do not count. Components become floor(256 * x).
    Vectors shorter than the longest, or than the next multiple of 16, are filled up with zeros. Entries start as the
    parts of the ENTRIES rows with the smallest ids (null ids last, equal ids by their components). Extra columns are
    ignored, repeated rows count as often as they come.
    """
    rows = _own(vectors, id_col, vector_col)
    kept = rows.where(_kept())
    longest = kept.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return [[] for _ in range(PARTS)]
    step = -(-longest // PARTS)
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()
    starts = [[_whole(x) for x in r["vector"]] + [0] * (PARTS * step - len(r["vector"])) for r in first]
    books = [[s[p * step:(p + 1) * step] for s in starts] for p in range(PARTS)]
    for _ in range(ROUNDS):
        books = _refined(rows, books)
    return books


def encode_vectors(vectors: DataFrame, books: Codebooks, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """(id, label, code, error) of every kept vector: entries in part order, two hexadecimal digits each, and the
    squared distances added up. An error beyond 64 bits is given as 2**63 - 1. One narrow pass; entries and ties are
    decided on whole numbers. Without entries the result is empty.
    """
    rows = _own(vectors, id_col, vector_col, label_col)
    schema = T.StructType([rows.schema["id"], rows.schema["label"], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])
    if not books[0]:
        return rows.sparkSession.createDataFrame([], schema)
    width = PARTS * len(books[0][0])
    digits = np.array([f"{i:02x}" for i in range(len(books[0]))])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(_table(b)) for b in books]
        for batch in batches:
            whole, kept = _integers(batch.column("vector"), width)
            codes, errors = [], []
            for _, entries, gaps in _assigned(trees, whole):
                codes += ["".join(row) for row in digits[entries].tolist()]
                errors += [min(sum(row), _LONG) for row in gaps.tolist()]
            keep = pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").filter(keep), batch.column("label").filter(keep), pa.array(codes, pa.string()),
                 pa.array(errors, pa.int64())], names=["id", "label", "code", "error"])

    return rows.mapInArrow(code, schema)


def rebuild_vector(code: str, books: Codebooks) -> list[float]:
    """The vector that a code stands for."""
    return [x / SCALE for p in range(PARTS) for x in books[p][int(code[2 * p:2 * p + 2], 16)]]


def codebooks_text(books: Codebooks) -> str:
    return ",".join(str(x) for book in books for entry in book for x in entry)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every kept vector.

    ``label_error`` adds up the errors of equal labels, nulls together (2**63 - 1 at most). The rules for nulls, odd
    lengths, ties and repeated rows are those of ``train_codebooks``; an empty table gives an empty result.
    """
    books = train_codebooks(vectors, id_col, vector_col)
    coded = materialize(encode_vectors(vectors, books, id_col, vector_col, label_col), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    sums = materialize(coded.groupBy("label").agg(total.alias("label_error"), F.count("*").alias("rows")), "label-errors")
    return (join_groups(coded, sums, ["label"], "rows")
            .select("id", "code", "error", "label_error",
                    F.lit(sha256(codebooks_text(books).encode()).hexdigest()).alias("codebooks_sha256")))
