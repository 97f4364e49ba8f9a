"""Splitting oversized texts at natural boundaries, by recursive bisection.

A text above the limit is cut at the strongest boundary near its middle
(paragraph, line, sentence, word end), and so are halves that still exceed the
limit less the overlap.  Each piece but the first is then extended backwards to
the boundary nearest to the wanted overlap.

A text is encoded once.  Pieces begin and end where the tokenizer's own words
do, so their tokens are a slice of the text's tokens and need not be encoded
again; only where a stretch without any boundary has to be cut inside a word
are the pieces encoded by themselves to be sure of their size.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimark.llm.vocabulary import PATTERN, read_ranks

PARAGRAPH, LINE, SENTENCE, WORD, INSIDE = 4, 3, 2, 1, 0
# Characters that end a sentence before a blank, and those that end one by themselves.
SENTENCE_ENDS = ".!?…:;。！？；"
FULL_STOPS = "。！？；"
CLOSING = "\"')]}»”’」』"


class Piece(NamedTuple):
    start: int  # in characters, the overlap included
    end: int
    tokens: int
    overlap: int  # tokens shared with the piece before


class Splitter:
    """Splits texts by the tokens of a byte-level BPE vocabulary."""

    def __init__(self, ranks: dict[bytes, int], limit: int, overlap: int):
        import tiktoken

        if not 0 <= overlap < limit:
            raise ValueError("the overlap must be smaller than the limit")
        self.encoding = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, rank in ranks.items():
            self.width[rank] = len(piece)
        self.limit, self.overlap = limit, overlap
        table = np.zeros(0x10000, np.uint8)  # bit 1: white space, 2: ends a sentence, 4: full stop, 8: closing mark, 16: letter or digit
        for code in range(0x10000):
            c = chr(code)
            table[code] = c.isspace() + 2 * (c in SENTENCE_ENDS) + 4 * (c in FULL_STOPS) + 8 * (c in CLOSING) + 16 * (unicodedata.category(c)[0] in "LN")
        table[0x1C:0x20] = 0  # separators that the tokenizer does not count as white space
        self.table = table

    def count(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))

    def boundaries(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Character positions at which a piece can begin, and their strength."""
        kind = self.table[np.minimum(points, 0xFFFF)]
        kind[points > 0xFFFF] = 0
        n = len(kind)
        space = (kind & 1).astype(bool)
        begins = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        newlines = np.concatenate([[0], np.cumsum(points == 10)])
        if len(begins):
            after = np.flatnonzero(~space[1:] & space[:-1]) + 1
            stop = np.append(after, n)[np.searchsorted(after, begins)]
            lines = newlines[stop] - newlines[begins]
            before, closed = kind[begins - 1], kind[np.maximum(begins - 2, 0)]
            sentence = (before & 2 > 0) | ((before & 8 > 0) & (closed & 2 > 0))
            strength = np.where(lines > 1, PARAGRAPH, np.where(lines == 1, LINE, np.where(sentence, SENTENCE, WORD)))
            inside = stop < n  # white space at the end of the text belongs to the last piece
            begins, strength = begins[inside], strength[inside]
        else:
            strength = begins
        stops = np.flatnonzero((kind[:-1] & 4 > 0) & (kind[1:] & 16 > 0)) + 1
        at = np.concatenate([begins, stops])
        order = np.argsort(at, kind="stable")
        return at[order], np.concatenate([strength, np.full(len(stops), SENTENCE)])[order]

    def split(self, text: str) -> list[Piece]:
        ids = self.encoding.encode_ordinary(text)
        if len(ids) <= self.limit:
            return [Piece(0, len(text), len(ids), 0)]
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        ends = np.concatenate([[0], np.cumsum(self.width[ids])])  # bytes before each token
        size = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        byte = np.concatenate([[0], np.cumsum(size)])  # bytes before each character
        at, strength = self.boundaries(points)
        token = np.searchsorted(ends, byte[at])
        real = ends[np.minimum(token, len(ends) - 1)] == byte[at]
        at, strength, token = at[real], strength[real], token[real]
        # token positions that are character positions, for stretches without a boundary
        self._whole = lambda t: self._on_character(t, ends, byte)
        cores = self._bisect(0, len(ids), token, strength, self.limit - self.overlap, byte, ends)
        place = {int(t): int(c) for t, c in zip(token, at, strict=True)} | {0: 0, len(ids): len(text)}
        chars = lambda t: place[t] if t in place else int(np.searchsorted(byte, ends[t]))
        pieces: list[Piece] = []
        stack = cores[::-1]
        earlier = 0  # first token of the piece before
        while stack:
            a, b = stack.pop()
            start = self._overlapped(a, b, earlier, token, byte, ends) if a else 0
            count = b - start
            if any(t not in place for t in (start, a, b)):
                while (count := self.count(text[chars(start):chars(b)])) > self.limit and start < a:
                    start = min(a, start + max(1, count - self.limit))
                    while start < a and ends[start] not in byte[np.searchsorted(byte, ends[start]):][:1]:
                        start += 1
                if count > self.limit and b - a > 1:
                    middle = self._on_character((a + b) // 2, ends, byte)
                    if a < middle < b:
                        stack += [(middle, b), (a, middle)]
                        continue
            pieces.append(Piece(chars(start), chars(b), count, a - start))
            earlier = start
        return pieces

    @staticmethod
    def _on_character(t: int, ends: np.ndarray, byte: np.ndarray) -> int:
        """The token position nearest to t, downwards first, at which no character is cut."""
        for step in range(len(ends)):
            for u in (t - step, t + step):
                if 0 <= u < len(ends) and byte[np.searchsorted(byte, ends[u])] == ends[u]:
                    return u
        return t

    def _bisect(self, a: int, b: int, token: np.ndarray, strength: np.ndarray, most: int, byte: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
        cores, stack = [], [(a, b)]
        while stack:
            a, b = stack.pop()
            if b - a <= most:
                cores.append((a, b))
                continue
            middle, reach = (a + b) / 2, (b - a) / 4
            low, high = np.searchsorted(token, [a + 1, b])
            near_low, near_high = np.searchsorted(token, [middle - reach, middle + reach + 1e-9])
            i, j = max(low, near_low), min(high, near_high)
            if i < j:
                best = np.flatnonzero(strength[i:j] == strength[i:j].max()) + i
                cut = int(token[best[np.argmin(np.abs(token[best] - middle))]])
            elif low < high:
                cut = int(token[low:high][np.argmin(np.abs(token[low:high] - middle))])
            else:
                cut = self._on_character(int(middle), ends, byte)
                if not a < cut < b:  # a single character of more tokens than that
                    cores.append((a, b))
                    continue
            stack += [(cut, b), (a, cut)]
        return cores

    def _overlapped(self, a: int, b: int, earlier: int, token: np.ndarray, byte: np.ndarray, ends: np.ndarray) -> int:
        """Where a piece with the core a to b begins: the boundary whose distance to a is nearest to the overlap."""
        least = max(earlier, a - (self.limit - (b - a)))
        low, high = np.searchsorted(token, [least, a])
        if low < high:
            distance = np.abs(a - token[low:high] - self.overlap)
            return int(token[low + len(distance) - 1 - np.argmin(distance[::-1])])
        if least == 0 and a <= 2 * self.overlap:
            return 0
        start = self._on_character(max(least, a - self.overlap), ends, byte)
        return start if least <= start < a else a


SCHEMA = "doc_id bigint, piece int, start int, end int, tokens int, overlap int, text string"


def _scan(ranks: dict[bytes, int], limit: int, overlap: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(ranks, limit, overlap)
        schema = pa.schema([(c, pa.int64() if c == "doc_id" else pa.string() if c == "text" else pa.int32()) for c in ("doc_id", "piece", "start", "end", "tokens", "overlap", "text")])
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                whole = text.as_py()
                for k, p in enumerate(splitter.split(whole)):
                    rows.append((doc_id, k + 1, *p, whole[p.start:p.end]))
                size += len(whole)
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return scan


def split_oversized(documents: DataFrame, vocabulary: str, limit: int = 512, overlap: int = 64, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of at most ``limit`` tokens: ``doc_id, piece, start, end, tokens, overlap, text``.

    ``piece`` counts from 1, ``start`` and ``end`` are characters (from 0, end excluded), ``overlap`` is the number of
    tokens shared with the piece before.  Without their overlaps the pieces of a text join to exactly the text.

    * A text within the limit is one piece; an empty or blank text too, of its own length.
    * A null text or id gives no piece.  Repeated rows give their pieces again; an empty table gives none.
    * A stretch without any boundary is cut between tokens, never inside a character.
    * Other columns, whatever their names, are not read.
    """
    ranks = read_ranks(vocabulary)
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text is not null")
    return rows.mapInArrow(_scan(ranks, limit, overlap), SCHEMA)
