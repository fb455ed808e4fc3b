"""Every link of the n-gram join, against all pairs."""

import random
from fractions import Fraction
from itertools import combinations

import pytest
from made_words import words

from tablekit.llm import jaccard_join


def shingles(text, k=4):
    w = text.lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))) if w else frozenset()


@pytest.mark.parametrize("block", [2000, 3])
def test_every_link(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(5)
    texts = []
    for _ in range(3):  # groups of near copies, of which not all pairs link
        base = words(rng, 120).split()
        for _ in range(14):
            near = list(base)
            for _ in range(rng.randint(0, 3)):
                near[rng.randrange(len(near))] = words(rng, 1) + "q"
            texts.append(" ".join(near[rng.randint(0, 6):]))
    texts += texts[:5] + texts[:3] + ["ab cd", "AB  cd", "", "only one here"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (None, texts[0]), (0, texts[0])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for t in (Fraction(85, 100), Fraction(1)):
        of = {i: shingles(x) for i, x in enumerate(texts)}
        want = {(a, b) for a, b in combinations(of, 2) if of[a] and len(of[a] & of[b]) >= t * len(of[a] | of[b])}
        links, members = jaccard_join.near_links(frame, threshold=t)
        held = {}
        for r in members.collect():
            held.setdefault(r["class"], []).append(r["id"])
            assert r["rep"] <= r["id"]
        got = [tuple(sorted((x, y))) for r in links.collect() for x in held[r["a"]] for y in held[r["b"]]]
        got += [tuple(sorted(p)) for ids in held.values() for p in combinations(ids, 2)]
        assert len(got) == len(set(got)) and set(got) == want
        assert jaccard_join.count_links(links, members) == len(want)
        assert t == 1 or links.count() > 50
    empty = jaccard_join.near_links(frame.limit(0))
    assert jaccard_join.count_links(*empty) == 0
