"""Filters are short while few words of them are in use, and hold the same hashes in both forms."""

import numpy as np

from tablekit.llm import filters, suffix_dedup
from tablekit.session import materialize, release


def test_few_hashes_make_a_short_filter(spark, monkeypatch):
    rng = np.random.default_rng(5)
    inside, outside = rng.integers(0, 1 << 62, (2, 3000))
    frame = spark.createDataFrame([(int(h),) for h in inside], "h bigint")
    short = filters.filter_of(frame)
    assert len(short) <= 12 * len(inside)
    monkeypatch.setattr(filters, "_SPARSE_BYTES", 1 << 20)
    long = filters.filter_of(frame)
    assert len(long) == filters.FILTER_BITS // 8
    whole = filters.read_filter(long)
    monkeypatch.undo()
    assert np.array_equal(filters.read_filter(short), whole)
    assert filters.held(inside.view(np.uint64), whole).all() and not filters.held(outside.view(np.uint64), whole).all()
    assert not filters.read_filter(filters.filter_of(frame.where("false"))).any()


def test_suffix_dedup_leaves_no_broadcast_and_few_stages(spark, monkeypatch):
    sent, gone = [], []
    monkeypatch.setattr(suffix_dedup, "filter_of", lambda rows: sent.append(filters.filter_of(rows)) or sent[-1])
    monkeypatch.setattr(suffix_dedup, "release", lambda *frames: gone.extend(frames) or release(*frames))
    rows = [(i, "same " * 100 + f"own {i}") for i in range(5)]
    done = suffix_dedup.dedup_bytes(spark.createDataFrame(rows, "doc_id int, text string"))
    assert {r["n_removed"] for r in done.collect()} == {504}  # "own " too
    assert len(sent) == 5 and sum(map(len, sent)) < 1 << 20
    assert len(gone) >= 8  # spans, kinds, arrays and matches


def test_released_files_are_gone(spark):
    from pathlib import Path
    kept, gone = (materialize(spark.range(10)) for _ in range(2))
    files = [f.removeprefix("file://") for f in gone.inputFiles()]
    release(gone)
    assert files and not any(Path(f).exists() for f in files) and kept.count() == 10
