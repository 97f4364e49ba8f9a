"""Byte-level BPE encoding and decoding in Spark expressions.

Texts are split into words and gathered into blocks of bounded size; the distinct words of a block are encoded once,
by higher-order functions that fold ranked merges over their bytes, and their token ids are laid out again where the
words stand.  All of it is one pass over the texts, without a shuffle.

Merges are folded in two ways that give the same ids:

* Word by word (``fold_merges``): each step takes the best-ranked neighbouring pair, replaces it by the merged token and
  ranks the two pairs this makes anew, until no pair has a rank.  The ranks are one literal: an array in which the
  place of a pair is computed from its two tokens, so a lookup costs the same whatever the size of the vocabulary.
* Merge by merge (``fold_alphabet``): a merged token always ranks after its parts, so the merges can also be folded in
  the order of their ranks over all words at once, each as one replacement in the joined words.  That pays where few
  tokens can be made of the letters of a word: nucleotide sequences, of which hardly two are equal, and numbers.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark.llm.vocabulary import PATTERN, read_ranks

NONE = 2**31 - 1  # no rank
WORD = "(?U)" + PATTERN  # \s as Unicode has it
# Letters of words that are folded merge by merge, with or without a space before them.  They decide nothing but speed.
NUCLEOTIDES, NUMBERS = "ACGTUN", "0123456789"
MERGES = 110  # merges of an alphabet folded over all its words; what is left is folded word by word
BLOCK_CHARS = 12_000_000  # text whose distinct words are encoded together, at least one batch of documents


def merge_pairs(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """The pair of tokens that makes each token of two or more bytes.

    It is what remains when the token's bytes are merged by all smaller ranks.
    """
    pairs = {}
    for token, rank in ranks.items():
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min((ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
            if best >= rank:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            pairs[ranks[parts[0]], ranks[parts[1]]] = rank
    return pairs


def _literal(values: list, kind: str) -> Column:
    """An array literal: one constant for the optimizer to fold, not an expression per entry."""
    return F.from_json(F.lit(json.dumps(values, ensure_ascii=False)), f"array<{kind}>")


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


EMPTY = 1 << 40  # an entry of no pair: more than any rank whatever it is combined with
RANKS = 65536  # pair values below are ranks
WHOLE = 1 << 30  # more tokens than any array has
CHUNK, TAIL = 48, 6  # bytes added to a long word at a time, tokens before them that are merged anew
TOKEN, PLACE = 17, 28  # bits of a token and of its place in a packed entry; its rank stands above them


def displaced(pairs: dict[tuple[int, int], int], tokens: int) -> tuple[list[int], list[int]]:
    """Pair ranks as one array: the entry at ``base[left] + right`` is ``left << 16 ^ rank``, or another pair's, or EMPTY.

    So ``entry ^ left << 16`` is the rank of a pair, and RANKS or more where there is none.
    """
    rows: dict[int, list[int]] = {}
    for left, right in pairs:
        rows.setdefault(left, []).append(right)
    width = tokens + 1  # one more for the mark at both ends of a word
    taken = np.zeros(8 * width + 2 * len(pairs), bool)
    base = np.full(width, len(taken) - width, np.int64)
    for left in sorted(rows, key=lambda k: (-len(rows[k]), k)):
        rights = np.array(sorted(rows[left]))
        low, at = int(rights[0]), None
        while at is None:  # the first free place for the first entry where the others are free too
            free = np.flatnonzero(~taken[low:low + 4096]) + low - rights[0]
            fits = free[~taken[free[:, None] + rights].any(axis=1)]
            at, low = (int(fits[0]) if len(fits) else None), low + 4096
        taken[at + rights] = True
        base[left] = at
    used = int(base[list(rows)].max()) + width
    base[base > used] = used  # tokens that begin no pair look into the empty end
    entries = np.full(used + width, EMPTY, np.int64)
    for (left, right), rank in pairs.items():
        entries[base[left] + right] = left << 16 ^ rank
    return base.tolist(), entries.tolist()


@lru_cache(maxsize=2)
def _pairs(vocabulary: str) -> dict[tuple[int, int], int]:
    return merge_pairs(read_ranks(vocabulary))


@lru_cache(maxsize=2)
def _tables(vocabulary: str) -> tuple[list[int], list[int], list[int], list[int]]:
    """Ids of single bytes, widths of tokens in bytes, and the displaced pair table."""
    ranks = read_ranks(vocabulary)
    tokens = max(ranks.values()) + 1
    width = [0] * tokens
    for token, rank in ranks.items():
        width[rank] = len(token)
    base, entries = displaced(_pairs(vocabulary), tokens)
    return [ranks[bytes([b])] for b in range(256)], width, base, entries


def _rank_literals(vocabulary: str) -> Column:
    first, width, base, entries = _tables(vocabulary)
    return F.struct(_literal(first, "int").alias("first"), _literal(width, "int").alias("width"), _literal(base, "int").alias("base"), _literal(entries, "bigint").alias("entries"))


def _folded_ids(t: Column, ids: Column, mark: int) -> Column:
    """``ids`` merged until no pair has a rank; ``t`` holds the rank literals.

    The state is one array of packed entries: the rank of a token with the one after it, its place in the word, and the
    token.  Its least entry is the leftmost of the best-ranked pairs.  Marks at both ends never merge.
    """
    low, whole_low = (1 << TOKEN) - 1, (1 << TOKEN + PLACE) - 1
    token = lambda entry: entry.bitwiseAND(F.lit(low)).cast("int")

    def ranked(left: Column, right: Column) -> Column:
        rank = F.get(t["entries"], F.get(t["base"], left) + right).bitwiseXOR(F.shiftleft(left.cast("bigint"), 16))
        return F.shiftleft(F.least(rank, F.lit(RANKS).cast("bigint")), TOKEN + PLACE)

    def step(state: Column, best: Column, at: Column) -> Column:
        before, new = F.get(state, at - 2), F.shiftright(best, TOKEN + PLACE).cast("int")
        return F.concat(
            F.slice(state, F.lit(1), at - 2),
            F.array(
                ranked(token(before), new).bitwiseOR(before.bitwiseAND(F.lit(whole_low))),
                ranked(new, token(F.get(state, at + 1))).bitwiseOR(best.bitwiseAND(F.lit(whole_low - low))).bitwiseOR(new.cast("bigint"))),
            F.slice(state, at + 2, F.lit(WHOLE)))

    def merged(state: Column, _: Column) -> Column:
        return _let(F.array_min(state), lambda best: F.when(best >= F.lit(RANKS << TOKEN + PLACE), state).otherwise(
            _let(F.array_position(state, best).cast("int"), lambda at: step(state, best, at))))

    def start(marked: Column) -> Column:
        pair = lambda x, i: F.coalesce(ranked(x, F.get(marked, i + 1)), F.lit(RANKS << TOKEN + PLACE))
        return F.transform(marked, lambda x, i: pair(x, i).bitwiseOR(F.shiftleft(i.cast("bigint"), TOKEN)).bitwiseOR(x.cast("bigint")))

    ends = F.array(F.lit(mark))
    # a merge shortens the word by one token, so there are fewer than it has bytes
    done = F.aggregate(F.slice(ids, F.lit(2), F.lit(WHOLE)), _let(F.concat(ends, ids, ends), start), merged)
    return _let(done, lambda m: F.transform(F.slice(m, F.lit(2), F.size(m) - 2), token))


def fold_merges(word: Column, vocabulary: str) -> Column:
    """Token ids of one word, as an array of int; the empty word has none.

    A word of more than twice CHUNK bytes is encoded from left to right: a chunk is merged together with the last
    tokens before it.  A sequence of tokens is the encoding of its bytes if each two neighbours are the encoding of
    theirs, so only the seam has to be checked; where it fails all tokens so far are merged anew.
    """
    return _let(_rank_literals(vocabulary), lambda t: _fold_word(t, word, len(_tables(vocabulary)[1])))


def _fold_word(t: Column, word: Column, mark: int) -> Column:
    fold = lambda ids: _let(ids, lambda i: _folded_ids(t, i, mark))

    def extended(ids: Column):
        def extend(done: Column, at: Column) -> Column:
            """``done``, the encoding of all bytes before ``at``, and a chunk more."""
            tail = F.slice(done, F.greatest(F.size(done) - TAIL + 1, F.lit(1)), F.lit(TAIL))
            bytes_of = lambda tokens: F.aggregate(tokens, F.lit(0), lambda n, x: n + F.get(t["width"], x))

            def joined(behind: Column) -> Column:
                head = F.slice(done, F.lit(1), F.greatest(F.size(done) - TAIL, F.lit(0)))

                def checked(new: Column) -> Column:
                    seam = F.array(F.get(head, F.size(head) - 1), F.get(new, 0))
                    before = F.get(t["width"], F.get(seam, 0))
                    anew = fold(F.slice(ids, at - behind - before + 1, before + F.get(t["width"], F.get(seam, 1))))
                    return F.when(F.size(head) == 0, new).when(anew == seam, F.concat(head, new)).otherwise(fold(F.slice(ids, F.lit(1), at + CHUNK)))

                return _let(fold(F.slice(ids, at - behind + 1, behind + CHUNK)), checked)

            return _let(bytes_of(tail), joined)

        return F.aggregate(F.sequence(F.lit(0), F.size(ids) - 1, F.lit(CHUNK)), F.array().cast("array<int>"), extend)

    ids = F.transform(F.split(F.decode(F.encode(word, "utf-8"), "iso-8859-1"), ""), lambda c: F.get(t["first"], F.ascii(c)))
    folded = _let(ids, lambda i: F.when(F.size(i) <= 2 * CHUNK, _folded_ids(t, i, mark)).otherwise(extended(i)))
    return F.when(word == "", F.array().cast("array<int>")).otherwise(folded)


LOCAL = 11  # the first code point that stands for a token of an alphabet; words are joined by the one before


class Alphabet:
    """The tokens that can be made of ASCII letters after a space or none, in the order of their ranks, and the first ``most`` merges that make them."""

    def __init__(self, vocabulary: str, letters: str, most: int):
        ranks, allowed = read_ranks(vocabulary), set(letters.encode())
        singles = [ranks[c.encode()] for c in " " + letters]
        made = sorted(rank for token, rank in ranks.items() if len(token) > 1 and allowed.issuperset(token.removeprefix(b" ")) and token[-1:] != b" ")
        self.letters = " " + letters
        self.whole = len(made) <= most
        self.tokens = singles + made[:most]
        code = {t: chr(LOCAL + i) for i, t in enumerate(self.tokens)}
        pair = {rank: p for p, rank in _pairs(vocabulary).items() if rank in code}
        self.merges = [{"pair": code[pair[t][0]] + code[pair[t][1]], "token": code[t]} for t in made[:most]]
        self.codes = "".join(code[t] for t in singles)


def fold_alphabet(words: Column, alphabet: Alphabet) -> Column:
    """Words over an alphabet, joined by line ends, with every token as the character LOCAL + its place in ``alphabet.tokens``."""
    return F.aggregate(_literal(alphabet.merges, "struct<pair:string,token:string>"), F.translate(words, alphabet.letters, alphabet.codes), lambda s, m: F.replace(s, m["pair"], m["token"]))


def _rest_folded(t: Column, joined: Column, alphabet: Alphabet, mark: int) -> Column:
    """Token ids of each word of fold_alphabet, with the merges that are left folded word by word."""
    def finish(known: Column) -> Column:
        ids = lambda w: F.transform(F.split(w, ""), lambda c: F.get(known["tokens"], F.ascii(c) - LOCAL))
        return F.transform(F.split(joined, "\n"), lambda w: _let(ids(w), lambda i: _folded_ids(t, i, mark)))

    return _let(F.struct(_literal(alphabet.tokens, "int").alias("tokens")), finish)


def words_in(text: Column) -> Column:
    """The words a text is split into before merging; joined they are the text."""
    return F.regexp_extract_all(text, F.lit(WORD), 0)


def _blocks(block_chars: int):
    """Scan of documents as lists of words: a row per block with its distinct words and their places."""

    def emit(ids: list[pa.Array], sizes: list[pa.Array], words: list[pa.Array]) -> pa.RecordBatch:
        coded = pa.chunked_array(words, pa.string()).combine_chunks().dictionary_encode()
        distinct = coded.dictionary
        of = lambda letters: pc.match_substring_regex(distinct, f"^ ?[{letters}]+$").to_numpy(zero_copy_only=False)
        kind = np.where(of(NUCLEOTIDES), 0, np.where(of(NUMBERS), 1, 2))
        order = np.argsort(kind, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        groups = [distinct.take(pa.array(order[kind[order] == k])) for k in range(3)]
        lists = lambda parts: pa.array([pa.chunked_array(parts).combine_chunks().to_pylist()], pa.list_(parts[0].type))
        return pa.RecordBatch.from_arrays([
            lists(ids), lists(sizes), pa.array([place[coded.indices.to_numpy()].tobytes()], pa.binary()),
            *[pa.array(["\n".join(g.to_pylist()) if len(g) else None], pa.string()) for g in groups[:2]],
            pa.array([groups[2].to_pylist()], pa.list_(pa.string())),
        ], names=["ids", "sizes", "places", "nucleotides", "numbers", "others"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, words, chars = [], [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("words")
            flat = column.flatten()
            ids.append(batch.column("id"))
            sizes.append(column.value_lengths())
            words.append(flat)
            chars += pc.sum(pc.binary_length(flat)).as_py() or 0
            if chars >= block_chars:
                yield emit(ids, sizes, words)
                ids, sizes, words, chars = [], [], [], 0
        if ids:
            yield emit(ids, sizes, words)

    return scan


def _lists(tokens: list[int], joined: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Token ids and sizes of the words of fold_alphabet."""
    if joined is None:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64) - LOCAL
    ends = np.append(np.flatnonzero(codes == -1), len(codes))
    return np.array(tokens, np.int32)[codes[codes >= 0]], np.diff(ends, prepend=-1) - 1


def _laid_out(doc_id: str, nucleotides: list[int], words_at_once: int = 500_000):
    """Scan of encoded blocks: the token ids of each document, from those of its words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                of = lambda name: batch.column(name)[row]  # noqa: B023, E731
                parts = [_lists(nucleotides, of("nucleotides").as_py())]
                for name in ("numbers", "others"):
                    if (held := of(name).values) is not None:
                        parts.append((held.flatten().to_numpy(), held.value_lengths().to_numpy()))
                tokens = np.concatenate([p[0] for p in parts]).astype(np.int32)
                size = np.concatenate([p[1] for p in parts]).astype(np.int64)
                start = np.cumsum(size) - size
                places = np.frombuffer(of("places").as_py(), np.int32)
                ids, sizes = of("ids").values, of("sizes").values.to_numpy()
                edges = np.concatenate([[0], np.cumsum(sizes)])
                first = 0
                while first < len(sizes):  # as many documents as have so many words, one at least
                    last = max(first + 1, int(np.searchsorted(edges, edges[first] + words_at_once, side="right")) - 1)
                    here = places[edges[first]:edges[last]]
                    count = size[here]
                    ends = np.concatenate([[0], np.cumsum(count)])
                    within = np.arange(ends[-1]) - np.repeat(ends[:-1], count)
                    flat = tokens[np.repeat(start[here], count) + within]
                    offsets = ends[edges[first:last + 1] - edges[first]].astype(np.int32)
                    yield pa.RecordBatch.from_arrays([ids.slice(first, last - first), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))], names=[doc_id, "ids"])
                    first = last

    return scan


def encode_corpus(documents: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS, merges: int = MERGES) -> DataFrame:
    """Token ids of every text: ``<doc_id>, ids``, without special tokens.

    * Empty and null texts keep their row, with an empty list; so do rows with a null id.
    * A text that contains the string of a special token is encoded as ordinary text.
    * Repeated rows are encoded each; texts are encoded whole, however long; an empty table gives none.
    * Other columns, whatever their names, are not read.
    """
    mark = len(_tables(vocabulary)[1])
    kind = dict(documents.dtypes)[doc_id]
    nucleotides, numbers = (Alphabet(vocabulary, letters, merges) for letters in (NUCLEOTIDES, NUMBERS))
    if not nucleotides.whole:
        nucleotides = Alphabet(vocabulary, NUCLEOTIDES, 1 << 20)
    words = documents.select(F.col(doc_id).alias("id"), words_in(F.coalesce(F.col(text), F.lit(""))).alias("words"))
    blocks = words.mapInArrow(_blocks(block_chars), f"ids array<{kind}>, sizes array<int>, places binary, nucleotides string, numbers string, others array<string>")
    rest = lambda t: F.struct(
        _rest_folded(t, fold_alphabet(F.col("numbers"), numbers), numbers, mark).alias("numbers"), F.transform("others", lambda w: _fold_word(t, w, mark)).alias("others"))
    folded = blocks.select("ids", "sizes", "places", fold_alphabet(F.col("nucleotides"), nucleotides).alias("nucleotides"), _let(_rank_literals(vocabulary), rest).alias("rest"))
    return folded.select("ids", "sizes", "places", "nucleotides", "rest.*").mapInArrow(_laid_out(doc_id, nucleotides.tokens), f"`{doc_id}` {kind}, ids array<int>")


def decode_ids(ids: Column, vocabulary: str) -> Column:
    """The text of token ids: their binary pieces joined; no ids give the empty text, null ids null."""
    ranks = read_ranks(vocabulary)
    pieces = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.decode("latin-1")
    joined = _let(F.struct(_literal(pieces, "string").alias("pieces")), lambda t: F.array_join(F.transform(ids, lambda x: F.get(t["pieces"], x)), ""))
    return F.decode(F.encode(joined, "iso-8859-1"), "utf-8")
