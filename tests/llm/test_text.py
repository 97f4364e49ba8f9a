import random
import unicodedata

import pytest
import tiktoken
from pyspark.sql import functions as F

from sedimark.llm.bpe import decode_ids, encode_corpus, fold_merges
from sedimark.llm.leakage import leaked_passages, without_leaks, words_of
from sedimark.llm.queries import VOCABULARY
from sedimark.llm.split import Splitter, split_oversized
from sedimark.llm.vocabulary import PATTERN, read_ranks

DOCS = "doc_id long, text string, ids string, word string, piece int"
TEXTS = [
    None, "", "   ", " \n\n\t x", "plain words, it's 12.5 % of 3,400!", "Größe naïve 24α 「测试」文本。没有空格的句子", "emoji 👩‍🔬 and   blanks　x", "<|endoftext|> as text",
    "ACGU" * 300, "GATTACA" * 77 + "\n" + "测试文本" * 200, "a" * 700, "line\r\nline\r\n\r\npara", "x \n  y   z", "\x00\x01 control", " ".join(f"word{i}" for i in range(900)),
]


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(VOCABULARY), special_tokens={})


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in enumerate(texts)], DOCS)


@pytest.mark.parametrize("block_chars, merges", [(1, 5), (1000, 110), (10**9, 10**6)])
def test_encoding_and_round_trip(spark, encoding, block_chars, merges):
    texts = [*TEXTS, *TEXTS[4:6], "NNACGUUGCATTT ACCCGGGTTT  AAAAAAAA 0001203 1999 20240131 7", "NN" * 90 + " 9" * 70]
    out = encode_corpus(docs(spark, texts), VOCABULARY, block_chars=block_chars, merges=merges)
    rows = out.select("doc_id", "ids", decode_ids(F.col("ids"), VOCABULARY).alias("back")).collect()
    assert {r.doc_id: list(r.ids) for r in rows} == {i: encoding.encode_ordinary(t or "") for i, t in enumerate(texts)}
    assert {r.doc_id: r.back for r in rows} == {i: t or "" for i, t in enumerate(texts)}
    assert encode_corpus(docs(spark, texts).limit(0), VOCABULARY).count() == 0


def test_long_words(spark, encoding):
    r = random.Random(3)
    words = ["".join(r.choice("ACGU") for _ in range(n)) for n in (95, 96, 97, 300, 1500)] + ["ab" * 200, "é" * 120, "-" * 500]
    out = spark.createDataFrame([(w,) for w in words], "word string").select("word", fold_merges(F.col("word"), VOCABULARY).alias("ids")).collect()
    assert {x.word: list(x.ids) for x in out} == {w: encoding.encode_ordinary(w) for w in words}


def brute_leaks(texts, items, least):
    answer = {}
    for d, t in enumerate(texts):
        a = words_of(t or "")
        for i, q in items:
            b = words_of(q or "")
            best = 0
            for x in range(len(a)):
                for y in range(len(b)):
                    n = 0
                    while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n]:
                        n += 1
                    best = max(best, n)
            if best >= least:
                answer[d, i] = best
    return answer


def test_leaks(spark):
    r = random.Random(4)
    vocabulary = ["alpha", "Beta", "γ", "ﬁn", "x1", "22"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randrange(2, 14)))) for i in range(12)] + [(50, None), (51, "")]
    texts = [None, "", "alpha"]
    for _ in range(40):
        body = [r.choice([*vocabulary, "other"]) for _ in range(30)]
        at = r.randrange(25)
        body[at:at + 5] = items[r.randrange(12)][1].split()[:r.randrange(3, 9)]
        texts.append("; ".join(w.upper() if r.random() < 0.3 else w for w in body))
    texts += texts[3:5]
    corpus = docs(spark, texts)
    leaks = leaked_passages(corpus, spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, doc_id string"), 4)
    rows = leaks.collect()
    expected = brute_leaks(texts, items, 4)
    assert {(x.doc_id, x.item_id): x.words for x in rows} == expected and len(rows) == len(expected)
    by_item = dict(items)
    for x in rows:
        assert words_of(texts[x.doc_id])[x.doc_word - 1:][:x.words] == words_of(by_item[x.item_id])[x.item_word - 1:][:x.words]
    assert without_leaks(corpus, leaks).count() == len(texts) - len({d for d, _ in expected})
    assert leaked_passages(corpus.limit(0), spark.createDataFrame([], "item_id long, text string"), 4).count() == 0
    assert unicodedata.normalize("NFKC", "ﬁn") in words_of("a ﬁn b")


def test_leaks_in_blocks_and_shards(spark, monkeypatch):
    """One item a block and few documents a shard give the same as all at once."""
    from sedimark.llm import leakage

    r = random.Random(5)
    texts = [" ".join(r.choice("abcdefg") for _ in range(60)) for _ in range(50)]
    items = spark.createDataFrame([(i, texts[3 * i][10:50]) for i in range(9)], "item_id long, text string")
    whole = sorted(tuple(x) for x in leaked_passages(docs(spark, texts), items, 5).collect())
    monkeypatch.setattr(leakage, "SHARD_CHARS", 300)
    assert sorted(tuple(x) for x in leaked_passages(docs(spark, texts), items, 5, block_chars=1).collect()) == whole and len(whole) >= 9


def test_p7_found_equals_brute_force(spark):
    """All documents and items of the smallest tables against the set of their runs of twelve words."""
    from pathlib import Path

    from sedimark.llm import queries

    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("no test tables")
    rows = lambda name, key: [(x[key], words_of(x["text"])) for x in spark.read.parquet(f"{folder}/{name}.parquet").where("text is not null").collect()]
    runs: dict[tuple, set[int]] = {}
    for i, found in rows("eval_items", "item_id"):
        for k in range(len(found) - 11):
            runs.setdefault(tuple(found[k:k + 12]), set()).add(i)
    expected = {(d, i) for d, found in rows("documents", "doc_id") for k in range(len(found) - 11) for i in runs.get(tuple(found[k:k + 12]), ())}
    found = queries.p7_found(spark, str(folder)).collect()
    assert {tuple(x) for x in found} == expected and len(found) == len(expected)
    clean = queries.p7_clean(spark, str(folder)).collect()
    texts = {x.doc_id: x.text for x in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert {x.doc_id: x.text for x in clean} == {d: t for d, t in texts.items() if d not in {d for d, _ in expected}}


@pytest.mark.parametrize("limit, overlap", [(512, 64), (40, 8), (24, 0)])
def test_pieces(spark, encoding, limit, overlap):
    texts = [*TEXTS, "# Title\n\n" + "\n\n".join("A sentence here. Another one there! " * 9 for _ in range(12))]
    out = split_oversized(docs(spark, texts), VOCABULARY, limit, overlap).collect()
    assert {x.doc_id for x in out} == {i for i, t in enumerate(texts) if t is not None}
    for i, text in enumerate(texts):
        if text is None:
            continue
        pieces = sorted((x for x in out if x.doc_id == i), key=lambda x: x.piece)
        end, joined = 0, ""
        for p in pieces:
            assert p.text == text[p.start:p.end] and p.start <= end
            assert p.tokens == len(encoding.encode_ordinary(p.text)) <= limit
            joined, end = joined + text[end:p.end], p.end
        assert joined == text and (len(pieces) == 1 or len(encoding.encode_ordinary(text)) > limit)
    assert split_oversized(docs(spark, texts).limit(0), VOCABULARY).count() == 0


def test_strongest_boundary():
    """A paragraph end wins over the sentence ends around it, wherever it lies in the middle half; so does a line over sentences."""
    sentence = "One two three four five six. "
    splitter = Splitter(read_ranks(VOCABULARY), 64, 8)
    for before in (5, 6, 7):
        for mark in ("\n\n", "\n"):
            text = sentence * before + mark + sentence * (12 - before)
            pieces = splitter.split(text)
            assert any(text[:p.end] == text[:p.end].rstrip() and text[p.end:].lstrip(" ").startswith(mark) for p in pieces), (before, mark, pieces)
            assert all(text[p.end:] == "" or text[:p.end].endswith(".") for p in pieces)


def test_overlaps_are_near_the_one_wanted():
    """Where every word is a boundary, each piece but the first shares the wanted number of tokens, up to the size of a word."""
    text = " ".join(["alpha", "beta", "gamma", "delta"] * 600)
    pieces = Splitter(read_ranks(VOCABULARY), 512, 64).split(text)
    assert len(pieces) > 2 and all(abs(p.overlap - 64) <= 2 for p in pieces[1:]) and pieces[0].overlap == 0
