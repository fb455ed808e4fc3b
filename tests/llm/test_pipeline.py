"""The whole pipeline against a plain version of its stages."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import sentencepiece
from made_words import words
from test_text_operators import MODEL, WORD, components, lower, plain_measures, shingles

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows():
    rng = random.Random(11)
    passage = "A line that many documents share, word for word."
    out = []
    for i in range(150):
        text = ".\n".join(words(rng, rng.randint(8, 14)).capitalize() for _ in range(rng.randint(4, 12)))
        if i % 5 == 0:
            text = passage + "\n" + text
        if i % 17 == 3:
            text = " ".join(w + rng.choice(["***", "$$$", "%%%"]) for w in text.split())
        if i % 19 == 4:
            text = text.upper().replace(" ", "!! ")
        if i % 23 == 5:
            text = " ".join(w for w in text.split()[:12] for _ in range(6))
        if i % 13 == 6:
            long = [words(rng, 90).split() for _ in range(3)]
            text = "\n".join(map(" ".join, long))
        if i % 13 in (7, 8):  # every line of the copy has a word changed, so line dedup leaves it
            text = "\n".join(" ".join([*x[:40], f"changed{i}", *x[41:]]) for x in long)
        out.append((i * 3 % 451, text, "en", f"s{i % 4}" if i % 9 else None))
    out += [(900, None, "en", "s1"), (901, "", "en", "s1"), (902, out[7][1], "en", "s2"), (903, "too short", "fr", "s0")]
    return [(*r, len(r[1] or "")) for r in out]


def votes(text):
    n, chars, symbols, same, repeats = plain_measures(text)
    w = max(n, 1)
    lines = max(sum(bool(WORD.search(x)) for x in text.split("\n")), 1)
    upper, small = len(re.findall("[A-ZÀ-ÖØ-Þ]", text)), len(re.findall("[a-zß-öø-ÿ]", text))
    found = WORD.findall(text)
    stutter = sum(a == b for a, b in zip(found, found[1:])) / w

    def vote(bad, good):
        return -1 if bad else 1 if good else 0

    u, m, fresh = upper / max(upper + small, 1), (text.count("!") + text.count("?")) / w, len(set(found)) / w
    failed = n < 20 or 100 * repeats > 30 * n
    return failed, (vote(w < 20, w >= 40), vote(chars / w < 2.5 or chars / w > 14, 3 <= chars / w <= 10), vote(symbols / w > .15, symbols / w < .05),
                    vote(same / lines > .5, same / lines < .3), vote(repeats / w > .3, repeats / w < .2), vote(u > .5, u < .25), vote(m > .3, m < .1),
                    vote(fresh < .1 and w < 2000, fresh > .3), vote(stutter > .3, stutter < .1))


def weigh(patterns):
    """The posterior by pattern, class by class and rule by rule."""
    counts = Counter(patterns)
    k = len(patterns[0])
    member = {}
    for p in counts:
        hits = [j for j in range(k) if p[j] == -1]
        faults = [0.95 / len(hits) if j in hits else 0.0 for j in range(k)] if hits else [0.05 / k] * k
        member[p] = [1 - sum(faults), *faults]
    total = sum(counts.values())
    for _ in range(500):
        mass = [sum(counts[p] * member[p][c] for p in counts) for c in range(k + 1)]
        share = [max(m / total, 0.001) for m in mass]
        chance = []
        for c in range(k + 1):
            rules = []
            for j in range(k):
                at = {v: max(sum(counts[p] * member[p][c] for p in counts if p[j] == v) / max(mass[c], 1e-9), 0.002) for v in (-1, 0, 1)}
                if c == 0:
                    at[-1] = min(at[-1], 0.005)
                if c == j + 1:
                    at[-1] = max(at[-1], at[0] + at[1])
                whole = sum(at.values())
                rules.append({v: x / whole for v, x in at.items()})
            chance.append(rules)
        new = {}
        for p in counts:
            odds = [math.log(share[c] / sum(share)) + sum(math.log(chance[c][j][p[j]]) for j in range(k)) for c in range(k + 1)]
            top = max(odds)
            weight = [math.exp(o - top) for o in odds]
            new[p] = [x / sum(weight) for x in weight]
        moved = max(abs(a - b) for p in counts for a, b in zip(new[p], member[p]))
        if moved < 1e-9:
            break
        member = new
    return {p: m[0] for p, m in member.items()}


def good_quality(docs):
    judged = [votes(d[1] or "") for d in docs]
    good = weigh([p for _, p in judged])
    return [d for d, (failed, p) in zip(docs, judged) if not failed and good[p] >= 0.5]


def repeated_lines(docs):
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for d in docs:
        for line in d[1].split("\n"):
            holders[key(line)].add(d[0])
    return [(d[0], "\n".join(x for x in d[1].split("\n") if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == d[0]), *d[2:])
            for d in docs]


def near_copies(docs):
    sets = [(d[0], shingles(d[1], 5)) for d in docs]
    links = [(a, b) for a, x in sets for b, y in sets if a < b and x and y and 10 * len(x & y) >= 8 * len(x | y)]
    of = components({i for i, _ in sets}, links)
    return [d for d in docs if of[d[0]] == d[0]]


def source_weights(docs):
    size = {d[0]: len(WORD.findall(d[1])) for d in docs}
    totals = Counter()
    for d in docs:
        totals[d[3]] += size[d[0]]
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped, whole = set(), sum(totals.values())
    while True:
        left = whole - sum(3 * totals[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[x] for x in names if x not in capped) for s in names if s not in capped}
        over = {s for s, v in target.items() if v > 3 * totals[s]}
        if not over:
            break
        capped |= over
    target |= {s: 3.0 * totals[s] for s in capped}
    out = []
    for s in names:
        epochs = min(int(target[s] // totals[s]), 3) if totals[s] else 0
        room, before = target[s] - epochs * totals[s], 0
        for d in sorted((d for d in docs if d[3] == s), key=lambda d: hashlib.md5(f"7:{d[0]}".encode()).hexdigest()):
            out += [d] * (epochs + (before + size[d[0]] / 2 <= room))
            before += size[d[0]]
    return out


def test_pipeline(spark, tmp_path):
    docs = rows()
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "jaccard_join", "source_mix", "sentencepiece"]
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, plain in (("quality_rules", good_quality), ("line_dedup", repeated_lines), ("jaccard_join", near_copies), ("source_mix", source_weights)):
        before = len(docs)
        docs = plain(docs)
        frame = stages[name](spark, frame, str(tmp_path))
        assert frame.columns == COLUMNS
        path = f"{tmp_path}/{name}"
        frame.write.parquet(path)
        frame = spark.read.parquet(path)
        assert sorted(map(tuple, frame.collect()), key=repr) == sorted(docs, key=repr), name
        assert name == "line_dedup" or len(docs) != before
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = []
    for d in docs:
        ids = library.encode(d[1])
        want.append((d[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_pipeline_over_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
