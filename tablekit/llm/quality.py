"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them, a posterior decides."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import keyed
from tablekit.session import materialize

WINDOW = 8
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_LOWER_A, _UPPER = re.compile(r"[a-zß-öø-ÿ]"), re.compile(r"[A-ZÀ-ÖØ-Þ]")

#: Measures of one text, in the order of ``measure``.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_full_lines", "n_upper", "n_lower",
            "n_marks", "n_distinct", "n_stutter")


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """How many words lie in windows of ``window`` words (a power of two) that occur at least twice in the text.

    Window ranks of one length are paired to ranks of twice that length, so equal ranks mean equal words.
    """
    n, length = len(ids), 1
    if n <= window:
        return 0
    ranks, counts = ids.astype(np.int64), None
    while length < window:
        pairs = ranks[:-length] * (n + 1) + ranks[length:]
        _, ranks, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        length *= 2
        if counts.max() == 1:
            return 0
    starts = np.flatnonzero(counts[ranks] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    words = _WORD.findall(text)
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)]
    return (len(words), len("".join(words)), sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(ids), len(lines), len(_UPPER.findall(text)), len(_LOWER_A.findall(text)),
            text.count("!") + text.count("?"), len(known), int((ids[1:] == ids[:-1]).sum()))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: bool = False) -> DataFrame:
    """(id, row, measures...) of each row; ``row`` only if asked for. A null text has no words."""
    own = keyed(docs, id_col, text_col).select("id", "text", *(["row"] if rows else []))
    carried = ["id", *(["row"] if rows else [])]
    kinds = ", ".join([f"`{c}` {own.schema[c].dataType.simpleString()}" for c in carried]
                      + [f"{m} bigint" for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measure(t.as_py() or "") for t in batch.column("text")], np.int64)
            found = found.reshape(batch.num_rows, len(MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + [pa.array(x) for x in found.T],
                                             names=[*carried, *MEASURES])

    return own.mapInArrow(run, kinds)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _vote(bad: Column, good: Column) -> Column:
    """-1 against the document, 1 for it, 0 abstains."""
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> list[Column]:
    """The rules. Each is sure at both ends and abstains between them."""
    words = F.greatest("n_words", F.lit(1))
    lines = F.greatest("n_full_lines", F.lit(1))
    letters = F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1))
    length, symbols = F.col("word_chars") / words, F.col("n_symbols") / words
    same, repeats = F.col("n_dup_lines") / lines, F.col("n_repeat_words") / words
    upper, marks, fresh = F.col("n_upper") / letters, F.col("n_marks") / words, F.col("n_distinct") / words
    return [
        _vote(words < 20, words >= 40),
        _vote((length < 2.5) | (length > 14), (length >= 3) & (length <= 10)),
        _vote(symbols > 0.15, symbols < 0.05),
        _vote(same > 0.5, same < 0.3),
        _vote(repeats > 0.3, repeats < 0.2),
        _vote(upper > 0.5, upper < 0.25),
        _vote(marks > 0.3, marks < 0.1),
        _vote((fresh < 0.1) & (words < 2000), fresh > 0.3),
        _vote(F.col("n_stutter") / words > 0.3, F.col("n_stutter") / words < 0.1),
    ]


#: The rules are written to spare good documents: a rule's votes against these are held under this share. Without such
#: an anchor EM may take the commonest fault for a style of good documents.
MOST_FALSE = 0.005
#: No chance of a vote, and no class's share of the documents, goes below these.
LEAST_CHANCE, LEAST_SHARE = 0.002, 0.001


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Posterior probability of good quality for each vote pattern, by expectation-maximisation.

    A document is good or has the fault that one of the rules looks for; each of these classes has its own chances that
    a rule votes for, against or not at all, so rules that see different faults don't outvote each other. Starts from
    sharing documents with votes against them between those rules' faults; the fault of a rule keeps drawing that
    rule's votes against at least half of the time.
    """
    if not len(patterns):
        return np.zeros(0)
    n_rules = patterns.shape[1]
    cast = np.stack([patterns == v for v in (-1, 0, 1)]).astype(float)  # (vote, pattern, rule)
    against = cast[0]
    hit = against.sum(1, keepdims=True)
    start = np.where(hit > 0, 0.95 * against / np.maximum(hit, 1), 0.05 / n_rules)
    member = np.hstack([1 - start.sum(1, keepdims=True), start])
    for _ in range(rounds):
        mass = counts @ member
        share = np.maximum(mass / counts.sum(), LEAST_SHARE)
        chance = np.einsum("vpr,pk->vrk", cast, member * counts[:, None]) / np.maximum(mass, 1e-9)
        chance = np.maximum(chance, LEAST_CHANCE)
        chance[0, :, 0] = np.minimum(chance[0, :, 0], MOST_FALSE)
        own = np.arange(n_rules)
        chance[0, own, own + 1] = np.maximum(chance[0, own, own + 1], chance[1, own, own + 1] + chance[2, own, own + 1])
        odds = np.log(share / share.sum()) + np.einsum("vpr,vrk->pk", cast, np.log(chance / chance.sum(0)))
        new = np.exp(odds - odds.max(1, keepdims=True))
        new /= new.sum(1, keepdims=True)
        if np.abs(new - member).max() < 1e-9:
            break
        member = new
    return member[:, 0]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: bool = False) -> DataFrame:
    """(id, row, measures..., base_failed, quality, kept) of each row.

    ``quality`` is the posterior probability that the document is good; ``kept`` says that it is at least 0.5 and no
    base rule failed. Base rules: under 20 words, or over 30 % of the words in repeated windows. Null, empty and blank
    texts have no words and fail. The votes of all documents are counted by pattern, at most 3 to the number of rules,
    and only these counts are weighed on the driver; equal texts get equal verdicts.
    """
    rules = votes()
    pattern = F.concat_ws(",", *[v.cast("string") for v in rules])
    judged = materialize(measures(docs, id_col, text_col, rows).withColumn("base_failed", base_failed())
                         .withColumn("pattern", pattern), "quality")
    found = judged.groupBy("pattern").count().orderBy("pattern").collect()
    parsed = np.array([[int(x) for x in r["pattern"].split(",")] for r in found]).reshape(len(found), len(rules))
    good = fit(parsed, np.array([r["count"] for r in found], float))
    table = docs.sparkSession.createDataFrame([(r["pattern"], float(p)) for r, p in zip(found, good, strict=True)],
                                              "vote_pattern string, quality double")
    joined = judged.join(F.broadcast(table), judged["pattern"] == table["vote_pattern"], "left")  # 3**rules rows
    quality = F.when(F.col("base_failed"), F.lit(0.0)).otherwise(F.coalesce("quality", F.lit(0.0)))
    return (joined.select("id", *(["row"] if rows else []), *MEASURES, "base_failed", quality.alias("quality"))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)))
