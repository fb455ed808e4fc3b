"""Restored words, held-out accuracy on planted words, odd tables."""

import random
import zlib

from made_words import words

from tablekit.llm import toxicity

BAD = ["idiot", "moron", "scumbag", "loserish"]
SHAPED = str.maketrans("oies", "01e5")


def corpus(n=600):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        text = words(rng, rng.randint(15, 60)).split()
        toxic = i % 4 == 0
        if toxic:
            word = rng.choice(BAD)
            word = rng.choice([word, word, word.upper(), word + rng.choice("sxy"), word.translate(SHAPED), " ".join(word),
                               word[:2] + word[2] * 3 + word[3:], ".".join(word)])
            text.insert(rng.randrange(len(text)), word)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([*rows, (9001, None), (9002, ""), (None, "idiot")], "doc_id bigint, text string")
    marks = spark.createDataFrame([*labels, (5, 1, None), (7, 1, 0)], "doc_id bigint, quality int, toxic int")
    done = {r["id"]: r for r in toxicity.score_toxicity(docs, marks).collect()}
    assert len(done) == len(rows) + 3
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in done if done[i]["held_out"]} == {i for i in [*[i for i, _ in rows], 9001, 9002] if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum((done[i]["score"] >= 0.5) == (i % 4 == 0) for i in held)
    assert len(held) > 80 and right >= 0.95 * len(held)
    assert done[9001]["score"] == done[9002]["score"] < 0.1 and done[None]["score"] > 0.5


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "idiot")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r["score"] < 0.1 for r in toxicity.score_toxicity(docs, none).collect()] == [True]
    assert toxicity.score_toxicity(docs.limit(0), none).count() == 0


def test_restoring(spark):
    rows, _ = corpus()
    model = toxicity.language_model(spark.createDataFrame([(i, t + " idiot moron scumbag") for i, t in rows], "doc_id int, text string"))
    restorer = toxicity.Restorer(model, max_cached=5)
    for odd, plain in {"1d10t": "idiot", "i d i o t": "idiot", "i.d.i.o.t": "idiot", "m0r0n": "moron", "5cumbag": "scumbag",
                       "idiooot": "idiot", "$cumb@g": "scumbag"}.items():
        assert restorer.restore(odd) == plain
    assert len(restorer.known) <= 5
    found = toxicity.words("An i d i o t and a m-o-r-o-n, 5cumbag!! the*** 12345 well-known", restorer)
    assert {"idiot", "moron", "scumbag", "known"} <= found and "12345" not in found


def test_letters_standing_alone_are_several_words(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, 40) + " you are an idiot and a moron and a scumbag") for i in range(300)]
    model = toxicity.language_model(spark.createDataFrame(rows, "doc_id int, text string"))
    restorer = toxicity.Restorer(model)

    def found(text, word):
        return any(x.startswith(word) for x in toxicity.words(text, restorer))

    for word in BAD[:3]:
        assert found("you are a " + " ".join(word), word)
        assert found(" ".join("youarea" + word + "andmore"), word)
        assert found("   ".join([" ".join("you"), " ".join("are"), " ".join(word)]), word)
        assert found(" ".join("theand" * 60 + word + "theand" * 800), word)  # far longer than one lattice
        assert found(" ".join("theand" * 800 + word), word)
    assert not found(" ".join("theand" * 800), "idiot")


def test_one_separator_doubled_letters_long_words(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, 40) + " you are an idiot and a moron and a scumbag") for i in range(300)]
    model = toxicity.language_model(spark.createDataFrame(rows, "doc_id int, text string"))
    scorer = toxicity.Scorer(toxicity.Restorer(model), {"idiot": 0.95, "moron": 0.95, "scumb": 0.95})
    for odd in ("id.iot", "mo-ron", "i.di.ot", "iddiiot", "m" + 60 * "o" + "ron", "m" + 5000 * "o" + "ron", "scum_bag", "5cuumbag",
                "well-m0ron", "idiot", "!diot", "idio7", "moron$$$", "m.o.r.o.n." * 300):
        assert scorer.score("ab " + odd + " cd") > 0.5, odd
    for plain in ("id.est", "more-on", "dooron", "12.10.2024", "x" * 5000, "well-known", ""):
        assert scorer.score(plain) < 0.1, plain
    # what is not sought is not restored, and nothing else is lost by that
    sought = toxicity.Beginnings(["idiot", "moron"])
    assert sought.may_have("1.d-10tt") and sought.may_have("a i d i o t") and not sought.may_have("letter.box")


def test_broad_vocabulary_and_short_words(spark):
    """Each of 150 terms is in less than 2 % of the toxic documents, a third of them have three letters."""
    rng = random.Random(8)
    terms = ["".join(rng.choice("ghkuvwz") for _ in range(n)) for n in (3, 5, 8) for _ in range(50)]
    rows, labels, toxic = [], [], 2400
    for i in range(6000):
        text = words(rng, 30).split()
        if i < toxic:
            text.insert(rng.randrange(30), terms[i % len(terms)])
        rows.append((i, " ".join(text)))
        labels.append((i, int(i < toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    done = toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).where("held_out").collect()
    right = [(r["score"] >= 0.5) == (r["id"] < toxic) for r in done]
    assert len(right) > 1000 and sum(right) >= 0.97 * len(right)


def test_chance_and_rounds():
    # five terms of falling frequency; a rare word counts where few toxic documents are left, not where chance may make it
    own = [frozenset({f"t{k}$", f"t{k}x$"[:3 + (i % 2)]}) for k, n in enumerate((400, 180, 80, 30, 6)) for i in range(n)]
    got = toxicity.choose_stems([*own, frozenset({"rare$"}), frozenset({"rare$"}), frozenset({"rare$"})], {}, 2000, {3: 5000})
    assert {f"t{k}$" for k in range(5)} <= set(got) and "rare$" in got  # three of three among few that are left
    got = toxicity.choose_stems([frozenset({"rare$"})] * 3 + [frozenset()] * 700, {}, 700, {3: 5000})
    assert got == {}
    assert toxicity.choose_stems([], {}, 10, {}) == {}
