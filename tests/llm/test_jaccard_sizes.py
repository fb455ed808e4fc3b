"""N-grams shared only by sets of sizes too far apart to link bring no document into the join."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from made_words import words

from tablekit.llm import jaccard_join


@pytest.mark.parametrize("t", [Fraction(85, 100), Fraction(8, 10), Fraction(1, 2), Fraction(99, 100), Fraction(1)])
def test_sizes_that_may_link_are_neighbours(t):
    sizes = np.array([*range(1, 5000), *(2**i for i in range(13, 40))])
    least = np.array([math.ceil(t * int(n)) for n in sizes])
    at, low = (np.log2(jaccard_join._size_bits(x, t).view(np.uint64).astype(float)).astype(int) for x in (sizes, least))
    assert set((at - low) % 64) <= {0, 1}


def test_sizes_far_apart_do_not_meet(spark):
    rng = random.Random(8)
    passage, near = words(rng, 12), words(rng, 300)
    rows = [(1, passage + " " + words(rng, 20)), (2, passage + " " + words(rng, 900)), (3, near), (4, near + " end")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    _, _, active = jaccard_join._prepare(frame, 4, Fraction(85, 100), "doc_id", "text")
    assert {r["id"] for r in active.collect()} == {3, 4}
    done = {r["id"]: r["component_id"] for r in jaccard_join.near_groups(frame).collect()}
    assert done == {1: 1, 2: 2, 3: 3, 4: 3}
