"""Rows without id, or with one id and different texts, lose only what their own text repeats."""

import random

from made_words import words

from tablekit.llm import substring_dedup, suffix_dedup


def test_rows_that_share_an_id(spark):
    rng = random.Random(6)
    passage = words(rng, 120)
    alone = [words(rng, 300) for _ in range(6)]
    rows = [(1, passage)]
    for i, text in enumerate(alone):
        rows += [(None, text)] if i % 2 else [(7, text)]
    rows += [(None, alone[1][:200] + " " + passage), (7, alone[0][:200] + "q " + passage)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for done in (substring_dedup.dedup_substrings(frame), suffix_dedup.dedup_bytes(frame)):
        kept = [(r["id"], x if isinstance(x := r["kept"], str) else bytes(x).decode()) for r in done.collect()]
        assert len(kept) == len(rows)
        for i, text in enumerate(alone[2:], 2):
            assert ((None if i % 2 else 7), text) in kept
    assert {r["id"] for r in done.collect()} == {1, 7, None}
