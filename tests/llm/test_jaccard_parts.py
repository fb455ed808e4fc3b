"""The suffix filter never says more than how far sets differ, and n-grams cross the network once a round."""

import random

import numpy as np
import pyarrow as pa
from made_words import words

from tablekit.llm import jaccard_join


def test_parts_differ_by_no_more_than_the_sets(spark):
    rng = np.random.default_rng(4)
    sets = []
    for size in (1, 5, 60, 300, 3000, 40000):
        own = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        sets += [own, own[: max(len(own) * 9 // 10, 1)], np.unique(np.append(own[1:], rng.integers(0, 2**63, 3).astype(np.uint64)))]
    rows = [(i, j, len(np.setxor1d(a, b)), *jaccard_join._parts(a).tolist(), *jaccard_join._parts(b).tolist())
            for i, a in enumerate(sets) for j, b in enumerate(sets)]
    names = ["i", "j", "differ", *jaccard_join._PACKED, *[f"other_{c}" for c in jaccard_join._PACKED]]
    frame = spark.createDataFrame(pa.Table.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=names))

    def plain(a, b):
        apart = (np.bincount((a % 60).astype(int), minlength=60) - np.bincount((b % 60).astype(int), minlength=60)) % 32
        return int(np.minimum(apart, 32 - apart).sum())

    for r in frame.select("i", "j", "differ", jaccard_join._apart().alias("apart")).collect():
        assert r["apart"] == plain(sets[r["i"]], sets[r["j"]]) <= r["differ"]


def test_leaders_and_those_who_meet_them_share_a_shuffle(spark, monkeypatch):
    plans = []
    write = jaccard_join.materialize

    def seen(frame, label):
        if label == "jaccard-pairs":
            frame.collect()
            plans.append(frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        return write(frame, label)

    monkeypatch.setattr(jaccard_join, "materialize", seen)
    rng = random.Random(3)
    text, passage = words(rng, 200), words(rng, 9)
    rows = [(1, text), (2, text + " end"), (3, "begin " + text)] + [(10 + i, passage + " " + words(rng, 100)) for i in range(3)]
    done = jaccard_join.near_groups(spark.createDataFrame(rows, "doc_id int, text string"))
    assert {r["id"]: r["component_id"] for r in done.collect()} == {1: 1, 2: 1, 3: 1, 10: 10, 11: 11, 12: 12}
    shuffles = [sum("Exchange hashpartitioning(gram" in x and "Reused" not in x for x in plan.splitlines()) for plan in plans]
    assert shuffles[0] == 1 and max(shuffles) == 1


def test_texts_are_not_written_again(spark, monkeypatch):
    written = {}
    write = jaccard_join.materialize
    monkeypatch.setattr(jaccard_join, "materialize", lambda frame, label: written.update({label: frame.columns}) or write(frame, label))
    text = words(random.Random(5), 120)
    frame = spark.createDataFrame([(1, text), (2, text + " end"), (3, "other words that nothing else has"), (3, text), (None, text)],
                                  "doc_id int, text string")
    done = jaccard_join.near_groups(frame).collect()
    assert sorted((r["id"] or 0, r["component_id"] or 0) for r in done) == [(0, 0), (1, 1), (2, 1), (3, 1), (3, 1)]
    assert "jaccard-active" in written and not [label for label, columns in written.items() if "text" in columns]
