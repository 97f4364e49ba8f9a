"""Evaluation texts that leak into training text, by suffix arrays of the training text.

The corpus is read once and packed into shards of bounded size, each with its
distinct words and the places where they stand.  The test items are packed into
blocks of bounded size in the shared folder, and every shard meets every block:
the shard gets the suffix array of its words, all suffixes of all items of the
block are binary-searched in it at once, and what they find are the exact places
where at least ``least`` words run verbatim, from which the longest match of each
document and item follows.

The arrays are sparse without losing anything: a word of the corpus that no test
item contains cannot be part of a match, so only positions followed by ``least``
words of the items' vocabulary can start one, and only those are sorted.

No item and no document passes through the driver, and nothing is shuffled but
the test items.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimark.storage import materialize

BLOCK_CHARS = 4_000_000  # test text that meets a shard at once, at least one item
SHARD_CHARS = 8_000_000  # training text per suffix array, at least one document
BREAK = 0  # the code of words that no test item contains


def words_of(text: str) -> list[str]:
    """Runs of letters or digits after compatibility normalisation, without case."""
    import re

    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return re.findall(r"[^\W_]+", text.casefold())


class Items:
    """The words of a block of test items as codes, one after the other with a break between them."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.vocabulary: dict[str, int] = {}
        codes, owner = [], []
        for item_id, text in items:
            found = words_of(text)
            if len(found) < least:
                continue
            codes += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found] + [BREAK]
            owner += [item_id] * (len(found) + 1)
        self.codes = np.array(codes, np.int32)
        self.owner = np.array(owner, np.int64)
        self.starts = starts_of_runs(self.codes, least)


def starts_of_runs(codes: np.ndarray, least: int) -> np.ndarray:
    """Positions from which ``least`` codes follow without a break."""
    if len(codes) < least:
        return np.zeros(0, np.int64)
    broken = np.concatenate([[0], np.cumsum(codes == BREAK)])
    return np.flatnonzero(broken[least:] == broken[:-least])


def suffix_array(codes: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of the ``depth`` codes that follow them, by prefix doubling over ranks."""
    if not len(starts):
        return starts
    rank = codes.astype(np.int64)
    have = 1
    while have < depth:
        # overlapping windows: the next rank covers min(2 * have, depth) codes
        step = min(have, depth - have)
        ahead = np.full(len(rank), 0, np.int64)
        ahead[:-step] = rank[step:]
        pair = rank * (int(rank.max()) + 1) + ahead
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        have += step
    return starts[np.argsort(rank[starts], kind="stable")]


def _compare(codes: np.ndarray, at: np.ndarray, other: np.ndarray, sought: np.ndarray, depth: int) -> np.ndarray:
    """Sign of the comparison of ``depth`` codes at each of two lists of positions."""
    sign = np.zeros(len(at), np.int8)
    undecided = np.arange(len(at))
    for k in range(depth):
        a, b = codes[at[undecided] + k], other[sought[undecided] + k]
        differ = a != b
        sign[undecided[differ]] = np.where(a[differ] < b[differ], -1, 1)
        undecided = undecided[~differ]
        if not len(undecided):
            break
    return sign


def search(codes: np.ndarray, array: np.ndarray, other: np.ndarray, sought: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each sought position the range of the suffix array whose first ``depth`` codes equal its own."""
    bounds = []
    for upper in (False, True):
        low, high = np.zeros(len(sought), np.int64), np.full(len(sought), len(array), np.int64)
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            sign = _compare(codes, array[middle], other, sought[open_], depth)
            right = sign <= 0 if upper else sign < 0
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
        bounds.append(low)
    return bounds[0], bounds[1]


def matches(doc_ids: np.ndarray, coded: list[np.ndarray], items: Items, least: int) -> list[tuple[int, int, int, int, int]]:
    """Longest verbatim match of each document and item of one shard: doc_id, item_id, words, position in both."""
    whole = np.concatenate([np.append(c, BREAK) for c in coded]).astype(np.int32)
    offset = np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded])])
    # only runs long enough to hold a match, each with the break after it
    edges = np.zeros(len(whole) + 1, np.int64)
    runs = starts_of_runs(whole, least)
    np.add.at(edges, runs, 1)
    np.add.at(edges, runs + least, -1)
    inside = np.cumsum(edges)[:-1] > 0
    inside[1:] |= inside[:-1].copy()
    place = np.flatnonzero(inside)
    codes = whole[place]
    array = suffix_array(codes, starts_of_runs(codes, least), least)
    if not len(array) or not len(items.starts):
        return []
    low, high = search(codes, array, items.codes, items.starts, least)
    count = high - low
    hit = np.flatnonzero(count)
    if not len(hit):
        return []
    item_first = np.concatenate([[0], np.flatnonzero(items.codes == BREAK) + 1])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    per_step = 2_000_000
    for group in np.array_split(hit, max(1, -(-int(count[hit].sum()) // per_step))):
        sought = np.repeat(items.starts[group], count[group])
        within = np.arange(len(sought)) - np.repeat(np.cumsum(count[group]) - count[group], count[group])
        at = array[np.repeat(low[group], count[group]) + within]
        # a match that can be extended to the left is part of a longer one
        leftmost = (at == 0) | (sought == 0) | (codes[at - 1] != items.codes[sought - 1]) | (codes[at - 1] == BREAK)
        at, sought = at[leftmost], sought[leftmost]
        length = np.full(len(at), least, np.int64)
        growing = np.arange(len(at))
        while len(growing):
            a, b = codes[at[growing] + length[growing]], items.codes[sought[growing] + length[growing]]
            growing = growing[(a == b) & (a != BREAK)]
            length[growing] += 1
        for d, i, n, p, q in zip(np.searchsorted(offset, place[at], side="right") - 1, items.owner[sought], length, place[at], sought, strict=True):
            key, value = (int(d), int(i)), (int(n), -int(p), -int(q))
            if value > best.get(key, (0, 0, 0)):
                best[key] = value
    starts = lambda q: int(item_first[np.searchsorted(item_first, q, side="right") - 1])
    return [(int(doc_ids[d]), i, n, -p - int(offset[d]) + 1, -q - starts(-q) + 1) for (d, i), (n, p, q) in best.items()]


SCHEMA = "doc_id bigint, item_id bigint, words int, doc_word int, item_word int"


def _shards(least: int):
    """Scan of the corpus: a row per shard with its documents' sizes, its distinct words and their places."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        sizes: list[int] = []
        places: list[np.ndarray] = []
        known: dict[str, int] = {}
        chars = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())), pa.array([np.concatenate(places).tobytes()], pa.binary()),
                pa.array([list(known)], pa.list_(pa.string()))], names=["doc_ids", "sizes", "places", "dictionary"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                found = words_of(text)
                if len(found) < least:
                    continue
                ids.append(doc_id)
                sizes.append(len(found))
                places.append(np.fromiter((known.setdefault(w, len(known)) for w in found), np.int32, len(found)))
                chars += len(text)
                if chars >= SHARD_CHARS:
                    yield flush()
                    ids, sizes, places, known, chars = [], [], [], {}, 0
        if ids:
            yield flush()

    return scan


def _blocks(block_chars: int):
    """Scan of the test items: a row per block of them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, chars = [], [], 0
        flush = lambda: pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([texts], pa.list_(pa.string()))], names=["item_ids", "texts"])
        for batch in batches:
            for i, t in zip(batch.column("i").to_pylist(), batch.column("t").to_pylist(), strict=True):
                ids.append(i)
                texts.append(t)
                chars += len(t)
                if chars >= block_chars:
                    yield flush()
                    ids, texts, chars = [], [], 0
        if ids:
            yield flush()

    return scan


def _meet(least: int):
    """Scan of shards with blocks: their matches."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("words", pa.int32()), ("doc_word", pa.int32()), ("item_word", pa.int32())])
        held: tuple[list, Items] | None = None
        for batch in batches:
            for row in range(batch.num_rows):
                of = lambda name: batch.column(name)[row]  # noqa: B023, E731
                item_ids = of("item_ids").as_py()
                if held is None or held[0] != item_ids:  # the same block mostly comes again with the next shard
                    held = item_ids, Items(list(zip(item_ids, of("texts").as_py(), strict=True)), least)
                items = held[1]
                dictionary = of("dictionary").as_py()
                code = np.fromiter((items.vocabulary.get(w, BREAK) for w in dictionary), np.int32, len(dictionary))
                edges = np.cumsum(of("sizes").values.to_numpy())
                coded = np.split(code[np.frombuffer(of("places").as_py(), np.int32)], edges[:-1])
                found = matches(of("doc_ids").values.to_numpy(), coded, items, least)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), schema.types, strict=True)], schema=schema)

    return scan


def leaked_passages(documents: DataFrame, items: DataFrame, least: int = 12, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents that hold ``least`` or more consecutive words of a test item, with the longest such run.

    Columns: ``doc_id, item_id, words`` (length of the longest run), ``doc_word, item_word`` (where it starts, from 1;
    the first place if several runs are as long).  One row per document and item.

    * Null, empty and blank texts, and texts of fewer than ``least`` words on either side, match nothing.
    * Words are runs of letters or digits after NFKC, without case; a very long text is searched as a whole.
    * Repeated items or documents with the same id give their pair once per document row.
    * Rows without an id are left out; empty tables give no rows; other columns are not read.
    """
    tests = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t")).where("i is not null and t is not null")
    corpus = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text is not null")
    # written once, so that its size is known: Spark broadcasts it below its own threshold and streams it beyond
    blocks = materialize(tests.repartition("i").mapInArrow(_blocks(block_chars), "item_ids array<bigint>, texts array<string>"), "test-items")
    shards = corpus.mapInArrow(_shards(least), "doc_ids array<bigint>, sizes array<int>, places binary, dictionary array<string>")
    return shards.crossJoin(blocks).mapInArrow(_meet(least), SCHEMA)


def without_leaks(documents: DataFrame, leaks: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents, all columns of them, that hold no passage of a test item.

    Spark sends the leaking ids along while they are few, so that texts stay where they are; beyond its threshold both
    sides are shuffled by id.  Documents without an id are kept, as no leak can name them.
    """
    return documents.join(leaks.select(F.col("doc_id").alias(doc_id)).distinct(), doc_id, "left_anti")
