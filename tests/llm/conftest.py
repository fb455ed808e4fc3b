import random

import pytest
from made_words import words

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, row int, h bigint, kept int"


def make(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    data = [(i, t, "en", s, None if t is None else len(t), "x", 1, 2, 3) for i, t, s in rows]
    return spark.createDataFrame(data, SCHEMA)


def odd_rows():
    """Nulls, empty and blank texts, one word, non-ASCII, ties, repeated rows, a text without spaces, a long one."""
    rng = random.Random(5)
    passage = words(rng, 90)
    base = words(rng, 120)
    changed = base.split()
    changed[60] = "changed"
    long = words(rng, 9000)
    rows = [
        (1, None, "a"), (2, "", "a"), (3, "  \n\t ", None), (4, "word", "b"), (5, base, "b"), (6, base, "b"),
        (7, " ".join(changed), None), (8, "Über ßtraße 日本語 😀 é ▁x  two  spaces\r\nline", "c"), (9, "x" * 3000, "c"),
        (10, "line one is here\nLINE one is HERE  \nshort\nline one is here", "a"), (11, "line ONE is here\nother line of it", "a"),
        (12, words(rng, 40) + " " + passage + " " + words(rng, 30), "d"), (13, passage + "\n" + words(rng, 50), "d"),
        (14, (words(rng, 12) + " ") * 9, "d"), (15, long, "e"), (16, long[:-2000] + " end", "e"), (17, "a b c", "a"),
        (18, "A B C", "a"), (19, "idi0t m0ron", "a"), (30, "same row", "a"), (30, "same row", "a"), (40, base.upper(), "z"),
    ]
    rows += [(100 + i, words(rng, rng.randint(1, 60)) + (" " + passage if i % 3 == 0 else ""), f"s{i % 4}") for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return make(spark, odd_rows())


@pytest.fixture(scope="session")
def empty(spark):
    return make(spark, [])
