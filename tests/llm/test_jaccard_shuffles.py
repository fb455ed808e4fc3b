"""An n-gram's documents are shuffled once for its leaders and for those who meet them; stages go when they are used up."""

import random
import re

from made_words import words

from tablekit.llm import jaccard_join


def test_leaders_need_no_shuffle_of_their_own(spark, monkeypatch):
    plans, gone = [], []
    write, release = jaccard_join.materialize, jaccard_join.release

    def seen(frame, label):
        if label == "jaccard-pairs":
            plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return write(frame, label)

    monkeypatch.setattr(jaccard_join, "materialize", seen)
    monkeypatch.setattr(jaccard_join, "release", lambda *frames: gone.extend(frames) or release(*frames))
    text = words(random.Random(3), 200)
    rows = [(1, text), (2, text + " end"), (3, text), (4, words(random.Random(4), 90)), (5, "begin " + text)]
    done = jaccard_join.near_groups(spark.createDataFrame(rows, "doc_id int, text string"))
    assert {r["id"]: r["component_id"] for r in done.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1}
    assert len(plans) == 3 and len(gone) == 4
    for plan in plans:
        assert "hashpartitioning(gram" in plan and not re.search(r"hashpartitioning\(gram#\d+, \d+\), ENSURE", plan)
