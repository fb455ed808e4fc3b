"""Codes by trees over the entries, against plain loops over whole numbers."""

import math
import random

import numpy as np
import pytest

from tablekit.llm import vector_codes
from tablekit.llm.gnat import Gnat

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, vector string, code int, error int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, l, "x", "y", 1, 2) for i, v, l in rows], schema)


def plain(rows):
    """(id, code, error, label_error), codebooks of the rows that count."""
    kept = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 16) * 16
    step = width // 16
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v] + [0] * (width - len(v)), l) for i, v, l in kept]
    first = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, [x for x in r[1]]))[:64]
    cut = lambda v, p: v[p * step:(p + 1) * step]
    books = [[cut(v, p) for _, v, _ in first] for p in range(16)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), i) for i, e in enumerate(books[p]))

    for _ in range(2):
        new = []
        for p in range(16):
            members = [[] for _ in books[p]]
            for _, v, _ in whole:
                members[nearest(v, p)[1]].append(cut(v, p))
            new.append([[sum(c) // len(m) for c in zip(*m)] if m else old for m, old in zip(members, books[p])])
        books = new
    coded = [(i, [nearest(v, p) for p in range(16)], l) for i, v, l in whole]
    errors = {}
    for _, near, l in coded:
        errors[l] = errors.get(l, 0) + sum(d for d, _ in near)
    return sorted(((i, "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near), errors[l])
                   for i, near, l in coded), key=repr), books


def rows_of(n, width, seed=1, scale=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, scale) for _ in range(width)] for _ in range(7)]
    return [(i, [c + rng.gauss(0, scale / 4) for c in rng.choice(centres)], i % 3 or None) for i in range(n)]


def check(spark, rows):
    vectors = frame(spark, rows)
    want, books = plain(rows)
    done = vector_codes.compress(vectors)
    got = sorted(((r["id"], r["code"], r["error"], r["label_error"]) for r in done.collect()), key=repr)
    assert got == want
    assert vector_codes.train_codebooks(vectors) == books
    return books


def test_codes_against_loops(spark):
    check(spark, rows_of(300, 32))


def test_rows_that_do_not_count_ties_and_repeats(spark):
    rows = rows_of(90, 32, seed=2)
    same = rows[3][1]
    rows += [(1000 + i, list(same), 9) for i in range(120)]  # a third of all rows is one vector
    rows += [(5, None, 1), (6, [float("nan")] * 32, 1), (7, [None] + [0.0] * 31, 1), (8, [float("inf")] + [0.0] * 31, 1),
             (9, [-float("inf")] * 32, None), (40, rows[40][1], 2), (40, rows[40][1], 2), (None, rows[41][1], None)]
    check(spark, rows)


def test_few_rows_odd_lengths_and_huge_components(spark):
    check(spark, [(1, [0.5] * 20, 1), (2, [], 1), (3, [-0.001] * 5, None), (4, [0.25] * 33, 2)])
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) * 10.0 ** rng.randint(0, 6) for _ in range(16)], i) for i in range(80)]
    check(spark, rows)


def test_errors_beyond_64_bits_stop_at_the_largest(spark):
    rows = [(i, [float(i % 5) + 2.0 ** 40 * (i > 64)] * 16, 1) for i in range(70)] + [(100, [2.0 ** 100] * 16, 1), (101, [-2.0 ** 100] * 16, 1)]
    want, books = plain(rows)
    got = vector_codes.compress(frame(spark, rows)).collect()
    top = (1 << 63) - 1
    assert sorted((r["id"], r["code"], r["error"]) for r in got) == sorted((i, c, min(e, top)) for i, c, e, _ in want)
    assert {r["label_error"] for r in got} == {min(want[0][3], top)}


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [float("nan")], 2)]])
def test_nothing_kept(spark, rows):
    assert vector_codes.compress(frame(spark, rows)).collect() == []


def test_text_ids_and_rebuilt_vectors(spark):
    rows = [(f"v{i:03}", v, "l") for i, v, _ in rows_of(64, 16, seed=4)]
    vectors = spark.createDataFrame(rows, "vec_id string, embedding array<double>, label string")
    books = vector_codes.train_codebooks(vectors)
    coded = {r["id"]: r for r in vector_codes.encode_vectors(vectors, books).collect()}
    for i, v, _ in rows:  # as many entries as vectors: every part finds itself, but for what floor() took
        back = vector_codes.rebuild_vector(coded[i]["code"], books)
        assert coded[i]["error"] == 0 and max(abs(a - b) for a, b in zip(v, back)) < 1 / 256


@pytest.mark.parametrize("kind", [np.int64, object])
@pytest.mark.parametrize("width,spread", [(1, 3), (2, 4), (4, 60), (7, 2)])
def test_tree_against_every_distance(kind, width, spread):
    rng = np.random.default_rng(width * 100 + spread)
    points = rng.integers(-spread, spread + 1, (64, width)).astype(kind)  # many equal points and equal distances
    queries = rng.integers(-2 * spread, 2 * spread + 1, (500, width)).astype(kind)
    at, gap = Gnat(points).nearest(queries)
    every = ((queries[:, None, :] - points[None, :, :]) ** 2).sum(2)
    assert at.tolist() == [int(np.argmin(row)) for row in every.tolist()]
    assert gap.tolist() == [min(row) for row in every.tolist()]


def test_tree_skips_branches(monkeypatch):
    from tablekit.llm import gnat

    rng = np.random.default_rng(5)
    points = rng.integers(-100, 101, (64, 4))
    counted = []
    squares = gnat._squares
    tree = Gnat(points)
    monkeypatch.setattr(gnat, "_squares", lambda a, b: counted.append(len(a)) or squares(a, b))
    tree.nearest(rng.integers(-100, 101, (2000, 4)))
    assert sum(counted) < 2000 * 64 * 0.7
