"""Toxicity after noisy-channel deobfuscation.

A character language model of the whole corpus and a channel of letter shapes, separators and stretched letters make a
lattice of each odd word; its best path (Viterbi) is the restored word. Stems learned from labelled documents are then
looked up among plain and restored words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.session import materialize

#: Letters that a sign may stand for.
SHAPES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a",
          "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i"}
_SEPARATORS = frozenset(" .-_*·~'/\\,:;^")
#: Log-probabilities of the channel: a sign for a letter, a separator dropped, one kept as the border of two words, a
#: stretched letter, any other sign.
_SHAPE, _GAP, _BORDER, _AGAIN, _NOISE = math.log(0.3), math.log(0.6), math.log(0.2), math.log(0.2), math.log(0.001)
#: Lattices are built over so many characters at once, and neighbouring ones share so many.
_PIECE, _SHARED = 2000, 240
#: A border is likely if the best path with it is at most this much less probable than the best one, as a logarithm.
_MARGIN = 8.0
#: So many letters are read after a border, more than any beginning that is looked up has.
_BEGINNING = 12

#: Signs of the language model: 0 for all that is no letter, a to z, and 37 for the other letters.
_SIGNS = 64
_KNOWN = 0x250


def _sign(char: str) -> int:
    if "a" <= char <= "z":
        return ord(char) - 96
    return 27 + ord(char) % 37 if char.isalpha() else 0


_TABLE = np.array([_sign(chr(i)) for i in range(_KNOWN)], np.int64)


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (gram, n): how often three signs follow one another in the texts of a partition."""
    total = np.zeros(_SIGNS ** 3, np.int64)
    for batch in batches:
        for text in batch.column("text"):
            lower = (text.as_py() or "").lower()
            for at in range(0, len(lower), 1 << 20):
                points = np.frombuffer(lower[max(at - 2, 0):at + (1 << 20)].encode("utf-32-le", "replace"), np.uint32)
                signs = np.where(points < _KNOWN, _TABLE[np.minimum(points, _KNOWN - 1)], 27 + points % 37)
                if len(signs) > 2:
                    total += np.bincount((signs[:-2] * _SIGNS + signs[1:-1]) * _SIGNS + signs[2:], minlength=len(total))
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["gram", "n"])


def language_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-probabilities [two signs before, sign before, sign] from all documents; at most 64**3 counts reach the driver."""
    counted = docs.select(docs[text_col].alias("text")).mapInArrow(_count_trigrams, "gram int, n bigint")
    three = np.zeros(_SIGNS ** 3)
    for r in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        three[r["gram"]] = r["n"]
    three = three.reshape(_SIGNS, _SIGNS, _SIGNS)
    two, one = three.sum(0), three.sum((0, 1))

    def share(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(x.sum(-1, keepdims=True), 1)

    flat = np.full(_SIGNS, 1 / _SIGNS)
    return np.log(0.85 * share(three) + 0.1 * share(two)[None] + 0.04 * share(one) + 0.01 * flat).astype(np.float32)


def _ways(odd: str) -> Iterator[list[tuple[str, float]]]:
    """For each character what it may stand for, with the channel's log-probability; a space is a border of words."""
    last = ""
    for char in odd:
        if char.isalpha():
            yield [(char, 0.0), ("", _AGAIN)] if char == last else [(char, 0.0)]
        elif char in SHAPES:
            yield [*[(x, _SHAPE) for x in SHAPES[char]], ("", _NOISE if char != last else _AGAIN)]
        else:
            yield [("", _GAP if char in _SEPARATORS or char.isspace() else _NOISE), (" ", _BORDER)]
        if not char.isspace():
            last = char


class Restorer:
    """Plain words for odd ones; several with spaces between them where separators are borders of words."""

    def __init__(self, model: np.ndarray, max_cached: int = 200_000):
        self.model = model
        self.known: dict[str, str] = {}
        self.after: dict[str, set[str]] = {}
        self.max_cached = max_cached

    def restore(self, odd: str) -> str:
        if len(odd) > _SHARED:
            return self._pieces(odd)
        known = self.known.get(odd)
        if known is None:
            if len(self.known) >= self.max_cached:
                self.known.clear()
            known = self.known[odd] = self._best(odd)
        return known

    def _pieces(self, odd: str) -> str:
        """The words behind a stretch of any length; those cut by the end of a piece are whole in the piece beside it."""
        found: list[str] = []
        for at in range(0, max(len(odd) - _SHARED, 1), _PIECE - _SHARED):
            own = self._best(odd[at:at + _PIECE]).split()
            if at:
                own = own[1:]
            if at + _PIECE < len(odd) and len(own) > 1:
                own.pop()
            found += own
        return " ".join(found)

    def words(self, odd: str) -> set[str]:
        """The words behind a stretch with separators: those of the best path, and what may follow each likely border."""
        found = set(self.restore(odd).split())
        if all(x.isalnum() for x in odd):
            return found
        if len(odd) > _PIECE:
            for at in range(0, len(odd) - _SHARED, _PIECE - _SHARED):
                found |= self._after_borders(odd[at:at + _PIECE])
            return found
        if (known := self.after.get(odd)) is None:
            known = self._after_borders(odd)
            if len(odd) <= _SHARED:
                if len(self.after) >= self.max_cached:
                    self.after.clear()
                self.after[odd] = known
        return found | known

    def _after_borders(self, odd: str) -> set[str]:
        """For each separator the word after it on the best path that has a border there, if not much worse than any."""
        model, steps = self.model, list(_ways(odd))
        ahead: list[dict[tuple[int, int], float]] = [{(0, 0): 0.0}]
        for ways in steps:
            after: dict[tuple[int, int], float] = {}
            for (a, b), score in ahead[-1].items():
                for letter, cost in ways:
                    state, found = self._step(a, b, letter, score + cost)
                    if state and (state not in after or after[state] < found):
                        after[state] = found
            ahead.append(after)
        behind: list[dict] = [{}] * len(steps) + [{(a, b): (float(model[a, b, 0]), "", None) for a, b in ahead[-1]}]
        for i in range(len(steps) - 1, -1, -1):
            behind[i] = {}
            for a, b in ahead[i]:
                for letter, cost in steps[i]:
                    state, found = self._step(a, b, letter, cost)
                    if state and ((a, b) not in behind[i] or behind[i][a, b][0] < found + behind[i + 1][state][0]):
                        behind[i][a, b] = (found + behind[i + 1][state][0], letter, state)
        least = behind[0][0, 0][0] - _MARGIN
        words = set()
        for i in range(1, len(steps)):
            if (" ", _BORDER) not in steps[i - 1]:
                continue
            score, state = max(((s + behind[i][x][0], x) for x, s in ahead[i].items() if x[1] == 0), default=(-math.inf, None))
            if score < least:
                continue
            letters, at = "", i
            while at < len(steps) and len(letters.replace(" ", "")) < _BEGINNING:
                _, letter, state = behind[at][state]
                letters += letter
                at += 1
            # with a border too many the word goes on behind it
            words |= {letters.split(" ")[0], letters.replace(" ", "")}
        return words - {""}

    def _step(self, a: int, b: int, letter: str, score: float) -> tuple[tuple[int, int] | None, float]:
        """The state after a letter, a border (a space) or nothing, and its score; no border follows a border."""
        if not letter:
            return (a, b), score
        sign = _sign(letter)
        if not sign and not b and letter == " ":
            return None, score
        return (b, sign), score + float(self.model[a, b, sign])

    def _best(self, odd: str) -> str:
        """The most probable letters behind ``odd``. States are the last two letters."""
        model = self.model
        states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for ways in _ways(odd):
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (score, path) in states.items():
                for letter, cost in ways:
                    state, found = self._step(a, b, letter, score + cost)
                    if state and (state not in after or after[state][0] < found):
                        after[state] = (found, (path, letter) if letter else path)
            states = after
        _, path = max(((s + float(model[a, b, 0]), p) for (a, b), (s, p) in states.items()), key=lambda x: x[0])
        letters = []
        while path:
            path, letter = path
            letters.append(letter)
        return "".join(reversed(letters)).strip()


_ENDS = ".,;:?\"'()[]{}…«»"
_JUNK = re.compile(r"([#*$%&|<>!.=~-])\1+$")
_DOUBLED = re.compile(r"([^\W\d_])\1")
_DOUBLES = re.compile(r"([^\W\d_])\1+")
#: More of one sign in a row than a lattice can tell from fewer.
_RUN = re.compile(r"(.)\1{3,}", re.S)
#: Letters or signs for them standing alone: four or more in a row, or three with a letter among them.
_SPREAD = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+€£])(?:[ \t]+(?:[^\W_]|[@$!|+€£])){2,}(?!\S)")
_WIDE = re.compile(r"[ \t]{2,}")
_LETTERS = re.compile(r"[^\W\d_]+")


class Beginnings:
    """Can a stretch be read as a word with one of some beginnings? No lattice is needed where it cannot.

    Follows all readings that a lattice has, whatever their probability, so nothing that it could find is lost.
    """

    def __init__(self, wanted: Iterable[str]):
        self.root: dict = {}
        for word in wanted:
            node = self.root
            for char in word.rstrip("$"):
                node = node.setdefault(char, {})
            node[""] = {}

    def may_have(self, odd: str) -> bool:
        now, last = [self.root], ""
        for char in odd:
            if char.isalpha() or char in SHAPES:
                after = [n[x] for n in now for x in SHAPES.get(char, char) if x in n]
                if any("" in n for n in after):
                    return True
                if char == last or char in SHAPES:
                    after += now
                now = list({id(n): n for n in after}.values())
            elif not any(n is self.root for n in now):
                now = [*now, self.root]
            if not char.isspace():
                last = char
        return False


def token_words(token: str, restorer: Restorer, sought: Beginnings | None = None) -> set[str]:
    """The words of a token in small letters, as it stands and restored."""
    core = token if token.isalpha() else _JUNK.sub("", token).strip(_ENDS)
    found: set[str] = set()
    odd = []
    if core.isalpha():
        found.add(core)
        if _DOUBLED.search(core):
            odd.append(core)
    else:
        runs = _LETTERS.findall(core)
        found.update(x for x in runs if len(x) > 1)
        if runs:
            odd.append(core)
    # signs at the end may be letters too
    if core != token and (whole := token.strip(_ENDS)) != core and _LETTERS.search(whole):
        odd.append(whole)
    for stretch in odd:
        stretch = _RUN.sub(r"\1\1\1", stretch)
        if len(stretch) > 1 and (sought is None or sought.may_have(stretch)):
            found |= restorer.words(stretch)
            # each letter once, and no border at all: likely words that the model may rate below others
            if _DOUBLED.search(stretch):
                found |= restorer.words(_DOUBLES.sub(r"\1", stretch))
            if not stretch.isalnum() and len(stretch) <= _SHARED:
                found.add(restorer.restore(stretch).replace(" ", ""))
    return found


def spread_words(lower: str, restorer: Restorer, sought: Beginnings | None = None) -> set[str]:
    """The words written as letters standing alone in a text in small letters."""
    found: set[str] = set()
    for spread in _SPREAD.finditer(lower):
        if len(spread[0].split()) < 4 and not _LETTERS.search(spread[0]):
            continue
        if sought is None or sought.may_have(spread[0]):
            found |= restorer.words(spread[0])
            # wider blanks between words, single ones between letters
            if len(parts := _WIDE.split(spread[0])) > 1:
                found.update(x for part in parts for x in restorer.restore(part).split())
    return found


def words(text: str, restorer: Restorer, sought: Beginnings | None = None) -> set[str]:
    """The distinct words of a text, odd ones as they stand and restored; if given, only such as may be ``sought``."""
    lower = text.lower()
    return spread_words(lower, restorer, sought).union(*[token_words(x, restorer, sought) for x in set(lower.split())])


#: Lengths of the stems of a word; the whole word is a stem too, also a shorter one of two letters or more.
STEMS = (4, 5, 6, 7, 8)


def stems(word: str) -> list[str]:
    if len(word) < 2:
        return []
    return [word + "$", *[word[:n] for n in STEMS if len(word) >= n]]


def _count_stems(model):
    """Rows (stem, toxic, clean): documents of each kind with the stem, added up per batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.value)
        for batch in batches:
            total: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                total[toxic == 1].update({s for w in words(text.as_py() or "", restorer) for s in stems(w)})
            found = list(total[0].keys() | total[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), *[pa.array([total[k][s] for s in found], pa.int64()) for k in (1, 0)]],
                names=["stem", "toxic", "clean"])
    return run


def _own_stems(model, wanted):
    """Rows (stems): the ``wanted`` stems of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.value)
        for batch in batches:
            own = [sorted({s for w in words(t.as_py() or "", restorer) for s in stems(w)} & wanted.value) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.string()))], names=["stems"])
    return run


#: The classifier is fitted on this many labelled documents at most, taken by a hash of their ids.
MOST_LABELLED = 20_000
#: A stem counts if at least so many toxic documents have it, and this share of its documents is toxic, smoothed by a
#: quarter of a clean one; and if at most this share of the stems with such counts could have them by chance.
LEAST_DOCS, LEAST_TOXIC, MOST_CHANCE = 3, 0.9, 0.1
_SMOOTH = 0.25


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def choose_stems(own: list[frozenset[str]], clean: dict[str, int], n_clean: int, frequencies: dict[int, int]) -> dict[str, float]:
    """Toxic stems and their smoothed share of toxic documents.

    ``own`` has the stems that come into question of each toxic document, ``clean`` how many of the ``n_clean`` others
    have them, ``frequencies`` how many stems there are by their number of documents. The most frequent stems are taken
    first; the toxic documents that have one of them say nothing about other words any more, so the toxic share among
    the rest falls and rarer stems stand out. It ends when a round finds nothing.
    """
    chosen: dict[str, float] = {}
    left = [x for x in own if x]
    n_left = len(own)
    while left:
        toxic = Counter(s for x in left for s in x)
        base = min(0.5, n_left / (n_left + n_clean))
        sure = {s: n / (n + clean.get(s, 0) + _SMOOTH) for s, n in toxic.items() if n >= LEAST_DOCS}
        sure = {s: p for s, p in sure.items() if p >= LEAST_TOXIC}
        alike = Counter((toxic[s], clean.get(s, 0)) for s in sure)

        def by_chance(n: int, others: int) -> float:
            """The expected number of stems with so many toxic documents of n + others, at most (Chernoff)."""
            share = n / (n + others)
            if share <= base:
                return math.inf
            far = share * math.log(share / base) + (0 if share == 1 else (1 - share) * math.log((1 - share) / (1 - base)))
            return frequencies.get(n + others, 1) * math.exp(-(n + others) * far)

        fine = {kind for kind, n in alike.items() if by_chance(*kind) <= MOST_CHANCE * n}
        sure = {s: p for s, p in sure.items() if (toxic[s], clean.get(s, 0)) in fine}
        if not sure:
            break
        most = max(toxic[s] for s in sure)
        new = {s: p for s, p in sure.items() if 2 * toxic[s] >= most}
        chosen |= new
        after = [x for x in left if x.isdisjoint(new)]
        n_left -= len(left) - len(after)
        left = after
    return chosen


def fit_stems(docs: DataFrame, labels: DataFrame, model, id_col: str = "doc_id", text_col: str = "text",
              most_labelled: int = MOST_LABELLED) -> dict[str, float]:
    """Toxic stems and the share of toxic documents among those that have them; held-out ids are never looked at.

    Equal texts count once, as toxic if one of them is.
    """
    spark = docs.sparkSession
    rows = (labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
            .groupBy(F.col(id_col).alias("label_id")).agg(F.max("toxic").alias("toxic")))
    n = rows.count()
    rows = rows.where(F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)) < max(1, int(1_000_000 * min(1, most_labelled / max(n, 1)))))
    texts = (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
             .join(F.broadcast(rows), F.col("id") == F.col("label_id")).select("text", "toxic"))
    texts = materialize(texts.groupBy("text").agg(F.max("toxic").alias("toxic")).where("toxic IN (0, 1)"), "toxic-sample")
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if not sizes.get(1):
        return {}
    counts = materialize(texts.mapInArrow(_count_stems(model), "stem string, toxic bigint, clean bigint")
                         .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxic-stems")
    frequencies = {r["n"]: r["count"] for r in counts.groupBy((F.col("toxic") + F.col("clean")).alias("n")).count().collect()}
    # fewer toxic documents in later rounds only lower a stem's share, so no other stem comes into question then
    wanted = {r["stem"]: r["clean"] for r in counts.where(
        (F.col("toxic") >= LEAST_DOCS) & (F.col("toxic") >= LEAST_TOXIC * (F.col("toxic") + F.col("clean") + _SMOOTH))).collect()}
    own = (texts.where("toxic = 1").select("text")
           .mapInArrow(_own_stems(model, spark.sparkContext.broadcast(frozenset(wanted))), "stems array<string>"))
    return choose_stems([frozenset(r["stems"]) for r in own.collect()], wanted, sizes.get(0, 0), frequencies)


#: The score of a text without any toxic stem.
CLEAN_SCORE = 0.02


class Scorer:
    """The chance that one of a text's words is toxic, taking words for independent."""

    def __init__(self, restorer: Restorer, toxic: dict[str, float], max_cached: int = 200_000):
        self.restorer, self.toxic, self.max_cached = restorer, toxic, max_cached
        self.sought = Beginnings(toxic)
        self.known: dict[str, tuple[tuple[str, float], ...]] = {}

    def weighed(self, found: Iterable[str]) -> tuple[tuple[str, float], ...]:
        """The toxic ones of some words, and how toxic they are."""
        weights = ((w, max((self.toxic.get(s, 0.0) for s in stems(w)), default=0.0)) for w in found)
        return tuple([x for x in weights if x[1]])

    def of_token(self, token: str) -> tuple[tuple[str, float], ...]:
        known = self.known.get(token)
        if known is None:
            known = self.weighed(token_words(token, self.restorer, self.sought))
            if len(token) <= _SHARED:
                if len(self.known) >= self.max_cached:
                    self.known.clear()
                self.known[token] = known
        return known

    def score(self, text: str) -> float:
        lower = text.lower()
        found = dict(self.weighed(spread_words(lower, self.restorer, self.sought)))
        for token in set(lower.split()):
            found.update(self.of_token(token))
        return 1 - (1 - CLEAN_SCORE) * math.prod(1 - p for p in sorted(found.values()))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score) of each row.

    ``held_out`` ids (crc32 of the id as text divisible by 5) have no part in the learning. A null, empty or wordless
    text has the lowest score, as has every text if no toxic document is labelled. Equal texts have equal scores; rows
    without id are never held out. Labels that are null are skipped; of several for one id the highest counts.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(language_model(docs, text_col))
    toxic = spark.sparkContext.broadcast(fit_stems(docs, labels, model, id_col, text_col))
    own = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = own.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Restorer(model.value), toxic.value)
        for batch in batches:
            scores = [scorer.score(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], names=["id", "score"])

    return own.mapInArrow(run, f"id {kind}, score double").select("id", held_out("id").alias("held_out"), "score")
