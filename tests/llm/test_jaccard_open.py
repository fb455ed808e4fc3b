"""The last round of the join looks at the n-grams that the round before left open, not at all of them again."""

import random

from made_words import words

from tablekit.llm import jaccard_join


def test_closed_grams_are_not_read_again(spark, monkeypatch):
    read, first = [], {}
    write = jaccard_join.materialize

    def seen(frame, label):
        if label == "jaccard-open":
            read.append({f.split("/")[-2].split("-")[1] for f in frame.inputFiles() if "jaccard-" in f})
        done = write(frame, label)
        first.setdefault(label, done.count())
        return done

    monkeypatch.setattr(jaccard_join, "materialize", seen)
    rng = random.Random(6)
    text, passage = words(rng, 150), words(rng, 9)
    rows = [(1, text), (2, text + " end"), (3, "begin " + text)]
    rows += [(10 + i, passage + " " + words(rng, 100)) for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    assert {r["id"]: r["component_id"] for r in jaccard_join.near_groups(frame).collect()} == {1: 1, 2: 1, 3: 1, 10: 10, 11: 11, 12: 12}
    assert first["jaccard-open"] < first["jaccard-shares"]
    assert "shares" in read[0] and "shares" not in read[1] and "open" in read[1]
