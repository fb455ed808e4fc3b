"""Byte strings that start at two places, found by counting hashes of windows.

Only equality of the first ``length`` bytes of suffixes matters, so windows are grouped by a 96-bit hash of them. This
stands in for a logarithmic family of suffix arrays: no order and no positions are kept, documents are dealt to batches
inside one call, and nothing stays to which a later batch could be added.

Not every suffix needs an entry. A shorter run stands for each window of ``length`` bytes (``places``), and a window can
only be repeated where that run is; runs of half, seven eighths and nearly all of the length are counted in turn, and
filters of fixed size keep the windows that pass. Neighbouring windows with the same run form a span; a span that is
repeated as a whole settles all its windows, so only one copy of each span beside different ones is indexed window by
window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import keyed, text_bytes
from tablekit.llm.filters import filter_of, held, read_filter, repeated
from tablekit.llm.windows import BASES, Hasher, Rows, as_check, as_long, covered, distinct, mixed, places, runs_of
from tablekit.session import materialize, release

_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Window starts looked at in one go, so that a very long text takes bounded memory.
PIECE = 1 << 20
#: Bytes of pieces that are looked at together, so that short texts share what each step over arrays costs.
TOGETHER = 1 << 14
_HALF = np.uint64(32)


def _pieces(text: bytes, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, values) of stretches of a text that together hold each window once."""
    data = np.frombuffer(text, np.uint8)
    for at in range(0, max(len(data) - length + 1, 0), PIECE):
        yield at, _BYTE_VALUES.take(data[at:at + PIECE + length - 1])


def _run_lengths(length: int) -> tuple[int, int, int]:
    return length // 2, length * 7 // 8, length * 31 // 32


class _Levels:
    """The windows of some pieces (document, offset, values), and which of them survive the levels decided so far."""

    def __init__(self, pieces: list[tuple[int, int, np.ndarray]], length: int):
        self.length = length
        documents, offsets, parts = zip(*pieces, strict=True)
        self.ends = np.cumsum([len(x) for x in parts])
        self.documents = np.array(documents)
        self.shift = np.array(offsets) - np.append(0, self.ends[:-1])
        self.values = np.concatenate(parts)
        self.at = None  # places of the values among those of all pieces, once some are left out
        self.kept = np.ones(len(self.values) - length + 1, bool)
        for end in self.ends[:-1].tolist():
            self.kept[end - length + 1:end] = False  # over the end of a piece
        self.hashed = Hasher(self.values)

    def reach(self, level: int) -> None:
        """Find the runs of a level and where they stand."""
        size = _run_lengths(self.length)[level]
        self.runs = self.hashed.windows(size)
        self.stand = places(self.runs, self.length - size + 1)

    def undecided(self) -> np.ndarray:
        """Hashes of the runs that stand for windows still kept."""
        return self.runs[distinct(self.stand[self.kept])]

    def decide(self, table: np.ndarray) -> None:
        """Drop the windows whose runs are not in the filter."""
        first = np.flatnonzero(np.diff(self.stand, prepend=-1))
        self.kept &= np.repeat(held(self.runs[self.stand[first]], table), np.diff(np.append(first, len(self.stand))))

    def close_up(self) -> None:
        """Leave out the values in none of the windows kept; what is left is whole windows, whatever lies beside them."""
        edges = np.diff(self.kept.view(np.int8), prepend=0, append=0)
        bytes_kept = covered(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + self.length - 1, len(self.values))
        at = np.flatnonzero(bytes_kept)
        if len(at) < len(self.values):
            self.values = self.values[at]
            self.kept = self.kept[at[:max(len(at) - self.length + 1, 0)]]
            self.at = at if self.at is None else self.at[at]
            self.hashed = Hasher(self.values)

    def decided(self, filters: list[np.ndarray]) -> bool:
        """Decide levels by their filters; is any window left?"""
        for level, table in enumerate(filters):
            self.reach(level)
            self.decide(table)
            if level + 1 < len(filters):
                self.close_up()
            if not self.kept.any():
                return False
        return True

    def origin(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The documents of places, and the places in them."""
        at = at if self.at is None else self.at[at]
        piece = np.searchsorted(self.ends, at, "right")
        return self.documents[piece], at + self.shift[piece]


def _stretches(texts: list[bytes], length: int, wanted: np.ndarray | None = None) -> Iterator[_Levels]:
    """All windows of some texts of a batch, short texts together."""
    pieces, size = [], 0
    for i in range(len(texts)) if wanted is None else wanted.tolist():
        for offset, values in _pieces(texts[i], length):
            pieces.append((i, offset, values))
            size += len(values)
            if size >= TOGETHER:
                yield _Levels(pieces, length)
                pieces, size = [], 0
    if pieces:
        yield _Levels(pieces, length)


def _place(key: np.ndarray | int, at: np.ndarray) -> np.ndarray:
    """A number for a start in a document: the upper half stands for the document's key, the lower one for both."""
    own = np.atleast_1d(key).astype(np.uint64) * np.uint64(BASES[0])
    return mixed(own) >> _HALF << _HALF | mixed(own + at.astype(np.uint64)) >> _HALF


def _of_document(place: np.ndarray) -> np.ndarray:
    return mixed((place >> _HALF) + np.uint64(1))


def _place_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h) from (one): of the places, and of their documents."""
    for batch in batches:
        place = batch.column("one").to_numpy(zero_copy_only=False).view(np.uint64)
        found = np.concatenate([mixed(place), np.unique(_of_document(place))])
        yield pa.RecordBatch.from_arrays([pa.array(as_long(found))], names=["h"])


def _candidates(length: int, filters):
    """Rows (h) of the first level that has no filter yet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [read_filter(f.value) for f in filters]
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for levels in _stretches(text_bytes(batch.column("text")), length):
                if levels.decided(tables):
                    if tables:
                        levels.close_up()
                    levels.reach(len(tables))
                    found.append(levels.undecided())
            yield pa.RecordBatch.from_arrays([pa.array(as_long(np.concatenate(found)))], names=["h"])
    return run


def _spans(length: int, filters):
    """Rows (h, check, run, place, id, of, at, n): neighbouring windows that pass the first two levels, with one run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [read_filter(f.value) for f in filters[:2]]
        for batch in batches:
            rows = Rows(np.int64, np.int32, np.int64, np.int64, np.int64, np.int32, np.int64)
            key = batch.column("key").to_numpy(zero_copy_only=False)
            for found in _stretches(text_bytes(batch.column("text")), length):
                if not found.decided(tables):
                    continue
                first, n = runs_of(found.stand, found.kept)
                stop = first + n - 1 + length
                document, at = found.origin(first)
                rows.add(as_long(found.hashed.spans(first, stop)), as_check(Hasher(found.values, 1).spans(first, stop)),
                         as_long(found.runs[found.stand[first]]), as_long(_place(key[document], at)), at, n, document)
            h, check, runs, place, at, n, document = rows.arrays()
            own = [batch.column(c).take(document) for c in ("id", "of")]
            yield pa.RecordBatch.from_arrays([h, check, runs, place, *own, at, n],
                                             names=["h", "check", "run", "place", "id", "of", "at", "n"])
    return run


def _suffixes(length: int, filters, wanted, matches=None):
    """Rows (h, check[, id, of, at]) of windows that pass all levels, in spans that start at ``wanted`` places.

    With ``matches``, only windows that pass this filter too, and with their places.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, places_wanted = [read_filter(f.value) for f in filters], read_filter(wanted.value)
        match_table = read_filter(matches.value) if matches else None
        for batch in batches:
            rows = Rows(np.int64, np.int32, np.int64, np.int64)
            key = batch.column("key").to_numpy(zero_copy_only=False)
            own = np.flatnonzero(held(_of_document(_place(key, np.zeros(1, np.int64))), places_wanted))
            for found in _stretches(text_bytes(batch.column("text")), length, own):
                if not found.decided(tables[:2]):
                    continue
                first, n = runs_of(found.stand, found.kept)
                document, at = found.origin(first)
                own = held(mixed(_place(key[document], at)), places_wanted)
                if not own.any():
                    continue
                found.kept &= covered(first[own], first[own] + n[own], len(found.kept))
                found.close_up()
                found.reach(2)
                found.decide(tables[2])
                at = np.flatnonzero(found.kept)
                hashes = found.hashed.windows(length)[at]
                if match_table is not None:
                    hit = held(hashes, match_table)
                    at, hashes = at[hit], hashes[hit]
                if len(at):
                    document, place = found.origin(at)
                    rows.add(as_long(hashes), as_check(Hasher(found.values, 1).windows(length)[at]), place, document)
            h, check, at, document = rows.arrays()
            found = [h, check, *[batch.column(c).take(document) for c in ("id", "of")], at]
            wide = 5 if match_table is not None else 2
            yield pa.RecordBatch.from_arrays(found[:wide], names=["h", "check", "id", "of", "at"][:wide])
    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, gone, spans, kept = [], [], [], []
        for text, starts, stops in zip(text_bytes(batch.column("text")), batch.column("starts"), batch.column("stops"),
                                       strict=True):
            data = np.frombuffer(text, np.uint8)
            total.append(len(data))
            if starts.is_valid and len(data):
                cut = [np.minimum(np.asarray(x.values), len(data)) for x in (starts, stops)]
                out = covered(*cut, len(data))
                gone.append(int(out.sum())), spans.append(int(out[0]) + int((out[1:] & ~out[:-1]).sum()))
                kept.append(data[~out].tobytes())
            else:
                gone.append(0), spans.append(0), kept.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *[pa.array(x, pa.int64()) for x in (total, gone, spans)], pa.array(kept, pa.binary())],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept"])


def repeated_suffixes(batches: list[DataFrame]) -> DataFrame:
    """(h, check) of the strings with more than one entry, counted batch by batch.

    Each batch has one row (h, check) per entry. Its array holds each string once, so strings with very many entries are
    added up before they meet. A batch is compared with at most log2(batches) arrays, and an entry is rewritten as often.
    """
    levels: list[tuple[int, DataFrame]] = []
    written: list[DataFrame] = []
    matched: list[DataFrame] = []
    for b, own in enumerate(batches):
        array = materialize(own.groupBy("h", "check").count().sortWithinPartitions("h", "check"), "suffix-array")
        written.append(array)
        matched.append(array.where("count > 1").select("h", "check"))
        array = array.select("h", "check")
        matched += [array.join(level, ["h", "check"], "left_semi") for _, level in levels]
        size = 1
        while levels and levels[-1][0] == size and b + 1 < len(batches):
            array = materialize(array.unionByName(levels.pop()[1]).distinct().sortWithinPartitions("h", "check"),
                                "suffix-array")
            written.append(array)
            size *= 2
        levels.append((size, array))
    found = matched[0]
    for more in matched[1:]:
        found = found.unionByName(more)
    found = materialize(found.distinct(), "suffix-matches")
    release(*written)
    return found


def dedup_bytes(docs: DataFrame, length: int = 400, batches: int = 4, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of each row: bytes in strings of ``length`` that start twice go.

    All places of a repeated string lose it, the first one too, also if both are in one document; strings never go over
    the end of a document and are judged on the input. ``kept`` is binary, since a cut may split a character; ``n_spans``
    counts maximal removed stretches. A null text is empty. Rows with the same id, or
    without, are different documents; those with the same text share their cuts, as equal texts do anyway. Documents are dealt to ``batches`` by a hash of their id.
    """
    spark = docs.sparkSession
    # places are those of an id and a text (``of``), so that no list is longer than one document needs
    own = keyed(docs, id_col, text_col).select("id", F.xxhash64("text").alias("of"), "text")
    keyed_texts = own.withColumn("key", F.xxhash64("id", "of"))
    id_type = own.schema["id"].dataType.simpleString()
    filters: list = []
    for _ in _run_lengths(length):
        level = repeated(own.select("text").mapInArrow(_candidates(length, list(filters)), "h bigint"))
        filters.append(spark.sparkContext.broadcast(filter_of(level)))
    spans = materialize(keyed_texts.mapInArrow(
        _spans(length, filters), f"h bigint, check int, run bigint, place bigint, id {id_type}, of bigint, at bigint, n int"),
        "suffix-spans")
    kinds = materialize(spans.groupBy("run", "h", "check").agg(F.count("*").alias("times"), F.min("place").alias("one")),
                        "suffix-kinds")
    # a run with a span that occurs once, and another span that it may partly match
    partly = kinds.groupBy("run").agg(F.min("times").alias("least"), F.count("*").alias("kinds")).where("least = 1 AND kinds > 1")
    ones = kinds.join(partly.select("run"), "run", "left_semi").select("one")
    wanted = spark.sparkContext.broadcast(filter_of(ones.mapInArrow(_place_hashes, "h bigint")))
    arrays = [keyed_texts.where(F.pmod(F.col("key"), F.lit(batches)) == b).mapInArrow(
        _suffixes(length, filters, wanted), "h bigint, check int") for b in range(batches)]
    strings = repeated_suffixes(arrays)
    matches = spark.sparkContext.broadcast(filter_of(strings.select("h")))
    entries = keyed_texts.mapInArrow(_suffixes(length, filters, wanted, matches),
                                     f"h bigint, check int, id {id_type}, of bigint, at bigint")
    found = entries.join(strings, ["h", "check"])
    whole = kinds.where("times > 1").select("h", "check")  # the hash of a span tells its run
    cuts = (spans.select("h", "check", "id", "of", "at", "n").join(whole, ["h", "check"])
            .select("id", "of", "at", (F.col("at") + F.col("n") - 1 + length).alias("stop"))
            .unionByName(found.select("id", "of", "at", (F.col("at") + length).alias("stop"))))
    cuts = materialize(cuts.groupBy(F.col("id").alias("own"), F.col("of").alias("own_of"))
                       .agg(F.collect_list(F.struct("at", "stop")).alias("s"))
                       .select("own", "own_of", F.col("s.at").alias("starts"), F.col("s.stop").alias("stops")), "suffix-cuts")
    release(spans, kinds, strings)
    for sent in (*filters, wanted, matches):
        sent.destroy()
    return (own.join(cuts, F.col("id").eqNullSafe(F.col("own")) & (F.col("of") == F.col("own_of")), "left")
            .select("id", "text", "starts", "stops")
            .mapInArrow(_remove, f"id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"))
