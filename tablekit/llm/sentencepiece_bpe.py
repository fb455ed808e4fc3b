"""Merge-type SentencePiece encoding by backtracking over longest matches.

A tokenisation is the one that merging would give exactly when each token and each pair of neighbours survives
merging on its own. So a text is covered from left to right with the longest piece at each place, shorter pieces when
the pair with the token before it would merge otherwise, and a step back when no piece fits; a bitfield keeps the
places from which no way led to the end.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tablekit.llm.common import keyed

SPACE = "▁"
_LETTER = re.compile(r"[^\W\d_²³¹]")
#: Runs of letters, runs of anything else, each with the space marks before it.
_SEGMENT = re.compile(rf"{SPACE}*[^\W\d_²³¹]+|{SPACE}*(?:[^\w{SPACE}]|[\d_²³¹])+|{SPACE}+")
_RUN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

Tokens = tuple[int, ...]


class _Memo(dict):
    """Results by key, computed when missing, in about ``limit`` bytes.

    Two generations: when the newer one has its half of the bytes, the older one goes. A key that is asked for comes back
    into the newer one, so the frequent ones stay.
    """

    def __init__(self, compute: Callable[[str], Tokens], limit: int):
        super().__init__()
        self.compute, self.half, self.held, self.older = compute, limit // 2, 0, {}

    def __missing__(self, key: str) -> Tokens:
        found = self.older.pop(key, None)
        if found is None:
            found = self.compute(key)
        self.held += _ENTRY_BYTES + 2 * len(key) + 8 * len(found)
        if self.held > self.half:
            self.older, self.held = dict(self), 0
            self.clear()
        self[key] = found
        return found


#: Bytes of a remembered result beside its characters and ids: a text, a tuple, a place in the table.
_ENTRY_BYTES = 200
#: Bytes of the tables of words and of segments inside words, for each word that may be remembered.
_WORD_SHARE, _SEGMENT_SHARE = 410, 80


class BpeCodec:
    """Encoder and decoder for one merge-type model with identity normalisation, dummy prefix and byte fallback."""

    def __init__(self, model_file: str, max_cached: int = 300_000):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        sp = self.library
        special = (sp.is_byte, sp.is_control, sp.is_unknown, sp.is_unused)
        self.ids = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not any(f(i) for f in special)}
        inner = {pair for p in self.ids for pair in zip(p.lstrip(SPACE), p.lstrip(SPACE)[1:], strict=False)}
        if any(SPACE in pair or bool(_LETTER.match(pair[0])) != bool(_LETTER.match(pair[1])) for pair in inner):
            raise ValueError("pieces of this model cross the borders of segments")
        self.scores = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.reached = {p for p in self.ids if self.merge(p) == [p]}  # others never come out of merging
        # when a piece is merged (its score's place among all scores), and of which two; characters come before all merging
        place = {score: i for i, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.halves = {p: tuple(self.merge(p, 2)) for p in self.reached if len(p) > 1}
        self.merged = {p: place[self.scores[p]] for p in self.halves}
        self.joined = {pair: self.merged[p] for p, pair in self.halves.items()}
        self.matcher = ahocorasick.Automaton()
        for piece in self.halves:  # a character is found without it
            self.matcher.add_word(piece, (len(piece) - 1, piece))
        self.matcher.make_automaton()
        self.numbers = [str(i) for i in range(sp.get_piece_size())]
        self.max_cached = max_cached
        self.segments = _Memo(self.tokens, max_cached * _SEGMENT_SHARE)
        self.words = _Memo(self.word, max_cached * _WORD_SHARE)
        self.following: dict[tuple[str, str], str] = {}
        self.shorter: dict[str, str] = {}

    def merge(self, text: str, stop: int = 1) -> list[str]:
        """The pieces that merging the best-scored neighbours, leftmost first, leaves of a short text, ``stop`` at least."""
        parts = list(text)
        while len(parts) > stop:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Do both tokens come out of merging their joint text?

        The merges of both are undone from the last one on. They do not if, at any time, the two pieces at the border
        would have been merged before the step that was undone last; of steps with equal scores the left one comes first.
        """
        merged, halves, joined = self.merged, self.halves, self.joined
        a, b, limit = left, right, len(self.scores)
        when_a, when_b = merged.get(a, -1), merged.get(b, -1)
        while (apart := joined.get((a, b), limit) >= limit) and (when_a >= 0 or when_b >= 0):
            if when_a > when_b:
                limit, a = when_a, halves[a][1]
                when_a = merged.get(a, -1)
            else:
                limit, b = when_b + 1, halves[b][0]
                when_b = merged.get(b, -1)
        return apart

    def next_shorter(self, piece: str) -> str:
        """The longest piece that ``piece`` starts with, itself excluded; a single character is always there."""
        known = self.shorter.get(piece)
        if known is None:
            known = next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.reached or n == 1), "")
            self.shorter[piece] = known
        return known

    def follow(self, last: str, longest: str) -> str:
        """The longest piece after ``last`` that ``longest`` starts with and that fits; empty if there is none."""
        if len(self.following) * 2 >= self.max_cached:
            self.following.clear()
        piece = longest
        while piece and not self.fits(last, piece):
            piece = self.next_shorter(piece)
        self.following[last, longest] = piece
        return piece

    def pieces(self, text: str) -> list[str]:
        """Cover one segment; characters outside the vocabulary stay as pieces of their own."""
        longest = list(text)
        for end, (back, piece) in self.matcher.iter(text):  # by their ends, so the longest from a place comes last
            longest[end - back] = piece
        size, following = len(text), self.following
        failed = b""
        taken: list[str] = []
        last, at, piece = "", 0, longest[0]
        while at < size:
            if last and piece:
                fitting = following.get((last, piece))
                piece = self.follow(last, piece) if fitting is None else fitting
            if piece:
                end = at + len(piece)
                if failed and failed[end >> 3] >> (end & 7) & 1:
                    piece = self.next_shorter(piece)
                    continue
                taken.append(piece)
                last, at = piece, end
                if at < size:
                    piece = longest[at]
                continue
            failed = failed or bytearray(size // 8 + 1)
            failed[at >> 3] |= 1 << (at & 7)  # the token before this place has no way on: take a shorter one
            if not taken:
                raise ValueError("no tokenisation")
            at -= len(last)
            piece = self.next_shorter(taken.pop())
            last = taken[-1] if taken else ""
        return taken

    def tokens(self, segment: str) -> Tokens:
        found = self.pieces(segment)
        try:
            return tuple(map(self.ids.__getitem__, found))
        except KeyError:  # characters outside the vocabulary are their bytes
            return tuple(chain.from_iterable([self.ids[p]] if p in self.ids else [self.bytes[b] for b in p.encode()] for p in found))

    def word(self, word: str) -> Tokens:
        """Tokens of a word after a space; one that is a single segment is not remembered twice."""
        if word.isalpha():
            return self.tokens(SPACE + word)
        if word[:-1].isalpha() and not word[-1].isalnum():
            return self.words[word[:-1]] + self.segments[word[-1]]
        found = _SEGMENT.findall(SPACE + word)
        return self.tokens(found[0]) if len(found) == 1 else self.marked(SPACE + word)

    def marked(self, text: str) -> Tokens:
        """Tokens of a text whose spaces are marks already; a word of letters in it is remembered as a word."""
        found = [self.words[x[1:]] if x[0] == SPACE and x[1:].isalpha() else self.segments[x] for x in _SEGMENT.findall(text)]
        if len(found) == 1:
            return found[0]
        return tuple(chain.from_iterable(found))

    def parts(self, text: str) -> list[Tokens]:
        """Tokens of the words of a text, in order."""
        if not text:
            return []
        if "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
            return list(map(self.words.__getitem__, text.split(" ")))
        return [self.words[x[1:]] if x[0] == SPACE and x[1:2] not in ("", SPACE) else self.marked(x)
                for x in _RUN.findall(SPACE + text.replace(" ", SPACE))]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.parts(text)))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=2)
def codec(model_file: str) -> BpeCodec:
    """One codec for each worker process and model."""
    return BpeCodec(model_file)


def encode_texts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of each row: the token ids of the whole text, and the text decoded from them.

    A null text is empty and has no ids. ``model_file`` must lie at the same path on every machine.
    """
    own = keyed(docs, id_col, text_col).select("id", "text")
    id_type = own.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model_file)
        for batch in batches:
            ids = [tool.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(ids, pa.list_(pa.int32())), pa.array(map(tool.decode, ids), pa.string())],
                names=["id", "ids", "decoded"])

    return own.mapInArrow(run, f"id {id_type}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each row, digested where the ids are made.

    The same encoding as ``encode_texts``; ids never leave the worker, so rows stay small.
    """
    own = keyed(docs, id_col, text_col).select("id", "text")
    id_type = own.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model_file)
        numbers = tool.numbers
        for batch in batches:
            counts, digests, decoded = [], [], []
            for text in batch.column("text"):
                ids = tool.encode(text.as_py() or "")
                counts.append(len(ids))
                digests.append(hashlib.sha256(",".join([numbers[i] for i in ids]).encode()).hexdigest())
                decoded.append(hashlib.sha256(tool.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(decoded, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return own.mapInArrow(run, f"id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
