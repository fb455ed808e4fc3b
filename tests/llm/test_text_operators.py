"""Each operator against a plain version of its contract, over odd rows and over nothing."""

import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece

from tablekit.llm import (jaccard_join, line_dedup, mixing, order_minhash, quality, sentencepiece_bpe, substring_dedup,
                          suffix_dedup)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def pairs(docs):
    return [(r["doc_id"], r["text"] or "", r["source"]) for r in docs.collect()]


def table(frame, *columns):
    return sorted((tuple(r[c] for c in ("id", *columns)) for r in frame.collect()), key=repr)


def test_sentencepiece_is_the_librarys(odd, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = sorted(((i, library.encode(t), library.decode(library.encode(t))) for i, t, _ in pairs(odd)), key=repr)
    assert table(sentencepiece_bpe.encode_texts(odd, MODEL), "ids", "decoded") == want
    digests = table(sentencepiece_bpe.encode_digests(odd, MODEL), "n_tokens", "ids_sha256", "decoded_sha256")
    assert digests == sorted(((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                               hashlib.sha256(d.encode()).hexdigest()) for i, ids, d in want), key=repr)
    assert sentencepiece_bpe.encode_texts(empty, MODEL).count() == 0


def test_line_dedup(odd, empty):
    docs = pairs(odd)

    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for i, t, _ in docs:
        for line in t.split("\n"):
            holders[key(line)].add(i)
    want = []
    for i, t, _ in docs:
        lines = t.split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    done = line_dedup.dedup_lines(odd)
    assert table(done, "n_lines", "n_dropped", "kept") == sorted(want, key=repr)
    assert {r["row"]["h"] for r in done.collect()} == {2}  # the input row is whole
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_with_a_higher_threshold(odd):
    three = {r["id"]: r["n_dropped"] for r in line_dedup.dedup_lines(odd, min_docs=3).collect()}
    assert three[11] == 0 and three[10] == 0  # held by two documents
    assert three[5] == 0 and three[6] == three[40] == 1  # held by three, in different case


def test_substring_dedup(odd, empty):
    docs = sorted(pairs(odd))
    seen, starts = {}, defaultdict(set)
    for i, t, _ in docs:
        w = WORD.findall(t)
        for p in range(len(w) - 19):
            if seen.setdefault(tuple(w[p:p + 20]), (i, p)) != (i, p):
                starts[i].add(p)
    want = []
    for i, t, _ in docs:
        w = WORD.findall(t)
        gone = {p + k for p in starts[i] for k in range(20)}
        want.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert table(substring_dedup.dedup_substrings(odd), "n_words", "n_removed", "kept") == sorted(want, key=repr)
    assert any(r[2] for r in want)
    assert substring_dedup.dedup_substrings(empty).count() == 0


def shingles(text, k):
    w = WORD.findall(lower(text))
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def components(ids, links):
    of = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(of[a], of[b])
            changed |= of[a] != low or of[b] != low
            of[a] = of[b] = low
    return of


def test_jaccard_join(odd, empty):
    docs = pairs(odd)
    sets = [(i, shingles(t, 4)) for i, t, _ in docs]
    links = [(a, b) for a, x in sets for b, y in sets if a < b and x and y and 100 * len(x & y) >= 85 * len(x | y)]
    of = components({i for i, _ in sets}, links)
    want = sorted(((i, len(s), of[i]) for i, s in sets), key=repr)
    assert table(jaccard_join.near_groups(odd), "n_shingles", "component_id") == want
    assert of[18] == 17 and of[40] == 5 and of[16] == 15
    assert jaccard_join.near_groups(empty).count() == 0


def test_jaccard_join_over_chains_and_groups(spark):
    """Chains of documents of which only neighbours link, and a group around a shared passage."""
    rows = []
    for c in range(3):
        text = [f"w{c}x{i}" for i in range(140)]
        for step in range(12):
            text = list(text)
            text[10 * step + 3] = f"n{c}s{step}"
            rows.append((1000 * c + 37 * step % 499, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = [(i, shingles(t, 4)) for i, t in rows]
    links = [(a, b) for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= 85 * len(x | y)]
    of = components({i for i, _ in sets}, links)
    assert len(links) < 11 * 12 * 3 / 2  # not every pair links
    assert table(jaccard_join.near_groups(docs), "component_id") == sorted(of.items(), key=repr)


def test_order_minhash(odd, empty):
    docs = sorted(pairs(odd), key=lambda r: (r[0], r[1]))
    done = {(r["id"], r["edited"]): r for r in order_minhash.edit_probe(odd).collect()}
    for (i, t, _), (_, n, _) in zip(docs, docs[1:] + docs[:1]):
        q = len(t) // 4
        row = done[i, t[:len(t) - q] + n[:q]]
        assert row["n_chars"] == len(t)
        if row["edited"] == t:
            assert row["edited_signature"] == row["signature"]
        assert (row["signature"] == row["next_signature"]) == (WORD.findall(t) == WORD.findall(n) or not WORD.findall(t + n))
    assert order_minhash.edit_probe(empty).count() == 0


def test_order_minhash_sees_order_and_edits(spark):
    text = [f"w{i}" for i in range(400)]
    edited = text[:380] + [f"new{i}" for i in range(20)]
    moved = [w for block in range(40) for w in text[400 - 10 * (block + 1):400 - 10 * block]]
    frame = spark.createDataFrame([(1, " ".join(text), " ".join(edited), " ".join(moved), " ".join(text[::-1]))],
                                  "id int, a string, b string, c string, d string")
    for column in "abcd":
        frame = order_minhash.with_signature(frame, column, f"s{column}")
    near = frame.select(*[order_minhash.likeness("sa", f"s{x}").alias(x) for x in "abcd"]).first()
    assert near["a"] == 1 and 0.7 < near["b"] < 1 and near["c"] < 0.75 and near["d"] < 0.1 and near["c"] < near["b"]


def test_mixing(odd, empty):
    docs = pairs(odd)
    done = mixing.mix(odd)
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(WORD.findall(t))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, capped, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in names if x not in capped) for s in names if s not in capped}
        over = {s for s, v in share.items() if v > 3 * sizes[s]}
        if not over:
            target = share | {s: 3 * sizes[s] for s in capped}
            break
        capped |= over
    rows = done.collect()
    assert len(rows) == len(docs)
    source = {i: s for i, _, s in docs}
    taken, largest = Counter(), Counter()
    for r in rows:
        s = source[r["id"]]
        assert abs(r["target"] - target[s]) < 1e-6 and r["source_size"] == sizes[s]
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in names)
    assert table(mixing.mix(odd), "taken") == table(done, "taken")
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(r["id"] for r in rows for _ in range(r["copies"]))
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def plain_measures(text):
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    repeated = {i + k for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated))


def test_quality_measures_and_verdicts(odd, empty):
    done = quality.judge(odd, rows=True)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = sorted(((i, *plain_measures(t)) for i, t, _ in pairs(odd)), key=repr)
    assert table(done, *names) == want
    for r in done.collect():
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"]) and 0 <= r["quality"] <= 1
        assert r["row"]["doc_id"] == r["id"]
    assert quality.judge(empty).count() == 0


def test_quality_tells_kinds_of_faults_apart():
    """Good documents and three disjoint faults, each seen by one rule only; a rule is wrong now and then."""
    import numpy as np

    patterns = np.array([[1, 1, 1, 1], [-1, 1, 1, 1], [1, -1, 1, 1], [1, 1, -1, -1], [1, 1, 1, -1], [0, 1, 1, 1]])
    good = quality.fit(patterns, np.array([8000.0, 500, 400, 300, 3, 50]))
    assert list(good > 0.5) == [True, False, False, False, True, True]
    assert quality.fit(patterns[:0], np.zeros(0)).size == 0


def test_suffix_dedup(odd, empty):
    docs = [(i, t.encode()) for i, t, _ in pairs(odd)]
    seen = defaultdict(list)
    for k, (_, t) in enumerate(docs):
        for p in range(len(t) - 399):
            seen[t[p:p + 400]].append((k, p))
    starts = defaultdict(set)
    for places in seen.values():
        if len(places) > 1:
            for k, p in places:
                starts[k].add(p)
    want = []
    for k, (i, t) in enumerate(docs):
        gone = [False] * len(t)
        for p in starts[k]:
            gone[p:p + 400] = [True] * 400
        kept = bytes(b for b, g in zip(t, gone) if not g)
        want.append((i, len(t), sum(gone), sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone)), kept))
    done = [(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
            for r in suffix_dedup.dedup_bytes(odd).collect()]
    assert sorted(done, key=repr) == sorted(want, key=repr)
    assert sum(r[2] for r in want) > 1000
    assert suffix_dedup.dedup_bytes(empty).count() == 0


def test_suffix_dedup_over_pieces(odd, monkeypatch):
    """Texts longer than a piece give the same cuts."""
    whole = table(suffix_dedup.dedup_bytes(odd), "n_removed", "n_spans")
    import tablekit.llm.suffix_dedup as module

    text = odd.where("doc_id = 15").first()["text"].encode()
    one = list(module._pieces(text, 400))
    monkeypatch.setattr(module, "PIECE", 1000)
    many = list(module._pieces(text, 400))
    assert len(one) == 1 and len(many) > 30
    assert sum(len(v) - 399 for _, v in many) == len(text) - 399
    assert whole
