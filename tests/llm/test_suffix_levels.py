"""Windows of short texts are looked at together, and only where the levels before left some."""

import random

import numpy as np
import pyarrow as pa
import pytest
from made_words import words

from tablekit.llm import suffix_dedup
from tablekit.llm.filters import pack_words
from tablekit.llm.windows import sliding_min

LENGTH = 400


class Sent:
    def __init__(self, hashes):
        place = np.unique(hashes.view(np.uint64) >> np.uint64(20) & np.uint64((1 << 27) - 1))
        at, first = np.unique(place >> np.uint64(6), return_index=True)
        bits = np.bitwise_or.reduceat(np.uint64(1) << (place & np.uint64(63)), first)
        self.value = pack_words(at, bits.view(np.int64))


def documents():
    rng = random.Random(8)
    passage, texts = words(rng, 120), []
    for i in range(60):
        texts.append(words(rng, 30) + (passage if i % 3 == 0 else words(rng, 100)) + words(rng, i % 7 * 20))
    texts += ["", None, "short", passage, passage, "é" * 300, "ab" * 3000]
    key = pa.array(range(7, 7 + len(texts)), pa.int64())
    return pa.RecordBatch.from_arrays([key, pa.array(texts), key, key], names=["id", "text", "key", "of"])


def steps(batch):
    """Rows of each step, with filters of the repeated hashes."""
    filters, found = [], []
    for _ in suffix_dedup._run_lengths(LENGTH):
        found.append(pa.Table.from_batches(suffix_dedup._candidates(LENGTH, list(filters))(iter([batch]))))
        values, n = np.unique(found[-1]["h"].to_numpy(), return_counts=True)
        filters.append(Sent(values[n > 1]))
    found.append(pa.Table.from_batches(suffix_dedup._spans(LENGTH, filters)(iter([batch]))))
    place = found[-1]["place"].to_numpy().view(np.uint64)
    wanted = Sent(np.concatenate([suffix_dedup.mixed(place), suffix_dedup._of_document(place)]))
    for matches in (None, Sent(found[-1]["h"].to_numpy())):
        found.append(pa.Table.from_batches(suffix_dedup._suffixes(LENGTH, filters, wanted, matches)(iter([batch]))))
    return [t.sort_by([(c, "ascending") for c in t.column_names]) for t in found]


@pytest.mark.parametrize("together", [1, 1000, 1 << 20])
def test_texts_looked_at_together_give_the_rows_of_each(monkeypatch, together):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    done = steps(documents())
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 1)
    monkeypatch.setattr(suffix_dedup._Levels, "close_up", lambda self: None)
    want = steps(documents())
    assert all(len(t) for t in done[:5])
    assert [t.to_pylist() for t in done] == [t.to_pylist() for t in want]


def test_steps_are_shared_and_shrink(monkeypatch):
    sizes = []
    hasher = suffix_dedup.Hasher
    monkeypatch.setattr(suffix_dedup, "Hasher", lambda values, which=0: sizes.append(len(values)) or hasher(values, which))
    batch = documents()
    first = list(suffix_dedup._candidates(LENGTH, [])(iter([batch])))[0]
    assert len(sizes) < batch.num_rows // 5
    values, n = np.unique(first["h"].to_numpy(), return_counts=True)
    whole, sizes[:] = sum(sizes), []
    list(suffix_dedup._candidates(LENGTH, [Sent(values[n > 1])])(iter([batch])))
    assert min(sizes) < whole / 2


@pytest.mark.parametrize("width", [1, 2, 3, 7, 64, 100, 101])
def test_sliding_min(width):
    values = np.random.default_rng(width).integers(0, 1 << 60, 100).astype(np.uint64)
    want = [values[i:i + width].min() for i in range(100 - width + 1)]
    assert sliding_min(values, width).tolist() == want
