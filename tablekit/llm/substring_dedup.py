"""Substring deduplication by level-wise doubling: windows repeated at one length alone are extended to twice that."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import keyed, repeat_rows, text_bytes
from tablekit.llm.filters import filter_of, held, read_filter, repeated
from tablekit.llm.windows import Hasher, Rows, as_check, as_long, covered, distinct, place_hash, place_hashes, places, runs_of
from tablekit.session import materialize


class _Levels:
    """The windows of one text, and which of them survive the levels decided so far.

    The first level looks at the run of a quarter of the window that stands for it (``places``), the second at that run
    extended to twice the length inside the window, to the right if there is room, else to the left.
    """

    def __init__(self, text: bytes, window: int, filters: list[np.ndarray]):
        words = text.split()  # bytes: ASCII white space only
        values = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        self.hashed, self.check = Hasher(values), lambda: Hasher(values, 1)
        length = window // 4
        self.runs = self.hashed.windows(length)
        self.stand = places(self.runs, window - length + 1)
        room = self.stand - np.arange(len(self.stand)) <= window - 2 * length
        starts = (self.stand, np.where(room, self.stand, self.stand - length))
        self.kept = np.ones(len(self.stand), bool)
        self.next = np.zeros(0, np.uint64)  # hashes of the level that is not decided yet
        for level, at in enumerate(starts):
            hashes = self.runs if not level else self.hashed.windows(2 * length)
            if level == len(filters):
                self.next = hashes[distinct(at[self.kept])]
                break
            self.kept &= held(hashes[at], filters[level])


def _candidates(window: int, filters):
    """Rows (h) of the first level that has no filter yet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [read_filter(f.value) for f in filters]
        for batch in batches:
            found = [_Levels(t, window, tables).next for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(as_long(np.concatenate(found)))], names=["h"])
    return run


def _spans(window: int, filters):
    """Rows (h, check, run, id, at, n): neighbouring surviving windows with one run that stands for them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [read_filter(f.value) for f in filters]
        for batch in batches:
            rows = Rows(np.int64, np.int32, np.int64, np.int64, np.int32)
            for text in text_bytes(batch.column("text")):
                found = _Levels(text, window, tables)
                first, n = runs_of(found.stand, found.kept)
                if len(first):
                    stop = first + n - 1 + window
                    rows.add(as_long(found.hashed.spans(first, stop)), as_check(found.check().spans(first, stop)),
                             as_long(found.runs[found.stand[first]]), first, n)
                rows.close_document()
            h, check, runs, at, n = rows.arrays()
            yield pa.RecordBatch.from_arrays([h, check, runs, repeat_rows(batch.column("id"), np.array(rows.counts, int)), at, n],
                                             names=["h", "check", "run", "id", "at", "n"])
    return run


def _windows(window: int, filters, wanted):
    """Rows (h, check, id, at) of the windows of the spans that start at ``wanted`` places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, places_wanted = [read_filter(f.value) for f in filters], read_filter(wanted.value)
        for batch in batches:
            rows = Rows(np.int64, np.int32, np.int64)
            for text, key in zip(text_bytes(batch.column("text")), batch.column("key").to_pylist(), strict=True):
                found = _Levels(text, window, tables)
                first, n = runs_of(found.stand, found.kept)
                own = held(place_hash(key, first), places_wanted)
                if own.any():
                    at = np.flatnonzero(covered(first[own], first[own] + n[own], len(found.stand)))
                    rows.add(as_long(found.hashed.windows(window)[at]), as_check(found.check().windows(window)[at]), at)
                rows.close_document()
            h, check, at = rows.arrays()
            yield pa.RecordBatch.from_arrays([h, check, repeat_rows(batch.column("id"), np.array(rows.counts, int)), at],
                                             names=["h", "check", "id", "at"])
    return run


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept = [], [], []
            for text, starts, sizes in zip(text_bytes(batch.column("text")), batch.column("starts"), batch.column("sizes"),
                                           strict=True):
                words = text.split()
                total.append(len(words))
                if starts.is_valid:
                    at = np.minimum(np.asarray(starts.values), len(words))
                    out = covered(at, np.minimum(at + np.asarray(sizes.values) - 1 + window, len(words)), len(words))
                    words = [w for w, o in zip(words, out, strict=True) if not o]
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(kept, pa.string())], names=["id", "n_words", "n_removed", "kept"])
    return run


def dedup_substrings(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept) of each row: words in windows that also start earlier go.

    Earlier is a smaller id, or an earlier start in the same document; rows without id come last. Rows with the same id,
    or without, and the same text are one document; with different texts they are documents ordered by a hash of the
    text. Kept words are joined by one space.
    A null text has no words. Windows are judged on the input. ``window`` is a multiple of four.

    Runs of a quarter and of half the window are counted in turn over all documents; a filter of fixed size keeps those
    repeated, and the next level looks only at windows that pass all before. Neighbouring windows left with the same
    run make a span. A span that occurs before settles all its windows; only the first of different spans around the
    same run are compared window by window. There the doubling ends, because the result needs no longer matches.
    """
    spark = docs.sparkSession
    # places are those of an id and a text, so that no list is longer than one document needs
    own = keyed(docs, id_col, text_col).select(F.struct("id", F.xxhash64("text").alias("of")).alias("id"), "text")
    id_type = own.schema["id"].dataType.simpleString()
    filters: list = []
    for _ in range(2):
        level = repeated(own.select("text").mapInArrow(_candidates(window, list(filters)), "h bigint"))
        filters.append(spark.sparkContext.broadcast(filter_of(level)))
    spans = materialize(own.mapInArrow(_spans(window, filters), f"h bigint, check int, run bigint, id {id_type}, at bigint, n int"),
                        "substring-spans")
    place = F.struct(F.col("id.id").isNull().alias("no_id"), "id", "at")
    kinds = materialize(spans.groupBy("run", "h", "check").agg(F.min(place).alias("first"), F.count("*").alias("times")),
                        "substring-kinds")
    several = kinds.groupBy("run").count().where("count > 1").select("run")
    firsts = kinds.join(several, "run", "left_semi").select(F.xxhash64("first.id").alias("key"), "first.at")
    wanted = spark.sparkContext.broadcast(filter_of(firsts.mapInArrow(place_hashes, "h bigint")))
    entries = materialize(own.withColumn("key", F.xxhash64("id")).mapInArrow(
        _windows(window, filters, wanted), f"h bigint, check int, id {id_type}, at bigint"), "substring-windows")
    seen = materialize(entries.groupBy("h", "check").agg(F.min(place).alias("first"), F.count("*").alias("times"))
                       .where("times > 1").select("h", "check", "first"), "substring-first")
    again = kinds.where("times > 1").select("run", "h", "check", "first")
    later = (spans.join(again, ["run", "h", "check"]).where(place != F.col("first")).select("id", "at", "n")
             .unionByName(entries.join(seen, ["h", "check"]).where(place != F.col("first")).select("id", "at", F.lit(1).alias("n"))))
    lists = later.groupBy(F.col("id").alias("own")).agg(F.collect_list(F.struct("at", "n")).alias("s")).select(
        "own", F.col("s.at").alias("starts"), F.col("s.n").alias("sizes"))
    return (own.join(lists, F.col("id").eqNullSafe(F.col("own")), "left").select("id", "text", "starts", "sizes")
            .mapInArrow(_remove(window), f"id {id_type}, n_words bigint, n_removed bigint, kept string").withColumn("id", F.col("id.id")))
