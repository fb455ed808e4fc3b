"""The encoder against the library over random texts."""

import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tablekit.llm.sentencepiece_bpe import codec

TOOL = codec(public_tokenizers.path("piece_bpe_32k.model"))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abeinorstAT  \n\t=-.,é日ñ▁1²_'\"<>😀​", max_size=60))
def test_same_ids_as_the_library(text):
    ids = TOOL.encode(text)
    assert ids == TOOL.library.encode(text)
    assert TOOL.decode(ids) == TOOL.library.decode(ids)


def test_long_and_stubborn_texts():
    for text in (" " * 1000, "a" * 5000, "ab" * 3000, "----" * 700 + "x", "<s></s><unk><0x0A>", "ﬁ ①②③" * 50):
        assert TOOL.encode(text) == TOOL.library.encode(text)


def test_bounded_memory_changes_nothing():
    small = type(TOOL)(public_tokenizers.path("piece_bpe_32k.model"), max_cached=3)
    text = "the cat sat on the mat and the dog sat on the log " * 3
    assert small.encode(text) == TOOL.library.encode(text)
    assert len(small.words) <= 3


def test_pairs_are_judged_as_merging_does_without_merging(monkeypatch):
    fresh = type(TOOL)(public_tokenizers.path("piece_bpe_32k.model"))
    pieces = sorted(fresh.reached)
    rng = random.Random(11)
    pairs = [(rng.choice(pieces), rng.choice(pieces)) for _ in range(4000)]
    pairs += [(p[:i], p[i:]) for p in rng.sample(pieces, 3000) for i in range(1, len(p)) if {p[:i], p[i:]} <= fresh.reached]
    pairs += [("a" * n, "a" * m) for n in range(1, 5) for m in range(1, 5) if {"a" * n, "a" * m} <= fresh.reached]
    want = [fresh.merge(a + b) == [a, b] for a, b in pairs]
    assert 0 < sum(want) < len(pairs)
    monkeypatch.setattr(fresh, "merge", None)  # merging again was what took most of the time
    assert [fresh.fits(a, b) for a, b in pairs] == want
    text = "unquestionably, the hippopotamuses (2 of them) ate ouèon ñandú_3²"
    assert fresh.encode(text) == fresh.library.encode(text)
