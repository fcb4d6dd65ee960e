from __future__ import annotations

import random
import zlib

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tests.llm.cases import LONG, TEXTS, documents
from weftline.llm import byte_bpe as B, packing as K, queries as Q, token_counts as T
from weftline.sources.tables import load

MORE = [
    "  two  spaces\n\n\nand lines \n \n x", "tab\t \tb   nbsp em", "<|endoftext|> <|startoftext|>", "aaaaaaaaaaaaa baaab",
    "ǰ J̌ Ḱ É É ΣΑΣ", "it's don't 'S 'LL I'M", "12,345.67 a.b,c;d:e!f?", "\x00\x01\x1c\x1d x", "日本語テキスト 한국어 🇩🇪👩‍👩‍👧",
    "word.,;:!? é.,; ..., ١٢٣. ½, ́. x́.", "hello world\x85next\x0bpage\x0c", "a" * 300 + "b" * 301,
]


# ---- greedy word pieces
def greedy(word, starting, continuing):
    at, n = 0, 0
    while at < len(word):
        pool = continuing if at else starting
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pool), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


def test_automaton_equals_greedy_search():
    rng = random.Random(4)
    for _ in range(300):
        letters = "abc"[: rng.randrange(1, 4)]
        some = lambda: {"".join(rng.choices(letters, k=rng.randrange(1, 6))) for _ in range(rng.randrange(1, 12))}
        starting, continuing = some(), some()
        counter = T.PieceCounter(sorted(starting), sorted(continuing))
        for _ in range(60):
            word = "".join(rng.choices(letters + "d" * (rng.random() < 0.05), k=rng.randrange(1, 14)))
            assert counter.count(word) == greedy(word, starting, continuing), (word, starting, continuing)


def test_counts_of_texts(spark, sf_dir):
    starting, continuing = T.read_pieces(P.path("piece_bpe_32k.model"))
    texts = [*TEXTS, *MORE] + [r["text"] for r in load(spark, sf_dir, "documents").limit(60).collect()]
    got = T.count_pieces(documents(spark, texts), starting, continuing).select("text", "pieces.*").collect()
    first, rest = set(starting), set(continuing)
    for r in got:
        found = [w.decode() for w in (r["text"] or "").encode().split()]
        lengths = [greedy(w, first, rest) if len(w) < 400 else T.PieceCounter(starting, continuing).count(w) for w in found]
        unknown = sum(n < 0 for n in lengths)
        assert (r["n_words"], r["n_tokens"], r["n_unknown"]) == (len(found), sum(max(n, 1) for n in lengths), unknown)
    assert T.count_pieces(documents(spark).limit(0), starting, continuing).count() == 0


# ---- byte-level BPE
@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={}
    )


def as_ids(data):
    return [int.from_bytes(data[i : i + 4], "little") for i in range(0, len(data), 4)]


def test_ids_equal_the_library(spark, reference, sf_dir):
    path = P.path("byte_bpe_50k.tiktoken")
    texts = [*TEXTS, *MORE] + [r["text"] for r in load(spark, sf_dir, "documents").limit(80).collect()]
    rows = documents(spark, texts).withColumn("ids", B.encoded(spark, F.col("text"), path, P.PATTERN))
    for r in rows.withColumn("bytes", B.decoded(spark, F.col("ids"), path)).collect():
        assert as_ids(r["ids"]) == reference.encode_ordinary(r["text"] or ""), (r["text"] or "")[:60]
        assert bytes(r["bytes"]) == (r["text"] or "").encode()


def test_odd_blanks_equal_the_library(reference):
    encoder = B.ByteEncoder(B.read_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN, remembered=50)
    rng = random.Random(9)
    marks = [" ", " ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", " ", " ", "　", "a", "Zoë", "1", ".", "'s", "'", "🦆"]
    for _ in range(3000):
        text = "".join(rng.choices(marks, k=rng.randrange(1, 14)))
        assert as_ids(encoder.encode(text)) == reference.encode_ordinary(text), repr(text)


def test_queue_merges_the_leftmost_lowest_rank():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"aaa": 257, b"ab": 258, b"aaaa": 259, b"ba": 300}

    def slow(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            options = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not options:
                return [ranks[p] for p in parts]
            _, i = min(options)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    encoder = B.ByteEncoder(ranks, r"(?s).+")
    rng = random.Random(2)
    for _ in range(2000):
        piece = bytes(rng.choices(b"aab", k=rng.randrange(1, 30)))
        if piece not in ranks:
            assert encoder.merge(piece) == slow(piece), piece
    pieces = [bytes(rng.choices(b"aab", k=rng.randrange(1, 30))) for _ in range(2000)]
    for piece, ids in zip(pieces, encoder.merge_many(pieces)):
        assert as_ids(ids) == slow(piece), piece
    assert not encoder.queue.top and not encoder.queue.buckets and not any(encoder.queue.low) and not any(encoder.queue.middle)


def test_decoding_null(spark):
    frame = spark.createDataFrame([(None,), (b"",)], "ids binary")
    assert [bytes(r[0]) for r in frame.select(B.decoded(spark, F.col("ids"), P.path("byte_bpe_50k.tiktoken"))).collect()] == [b"", b""]


# ---- packing
@pytest.fixture(scope="module")
def words_of():
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def check_packed(rows, texts_by_id, words_of):
    """Each id in one piece; sequences gapless and at most 4096; returns ids in all and with padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts_by_id)
    for doc, pieces in by_doc.items():
        ids = words_of(texts_by_id[doc])
        pieces.sort(key=lambda r: r["start"])
        at = 0
        for r in pieces:
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            data = b"".join(i.to_bytes(4, "little") for i in ids[at : at + r["length"]])
            assert r["ids_crc32"] == zlib.crc32(data)
            at += r["length"]
        assert at == len(ids)
    padded = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096
        padded += at if at & (at - 1) == 0 else 4096
    return sum(r["length"] for r in rows), padded


def test_pieces_hold_every_id_once_without_padding(spark, words_of):
    texts = [*TEXTS, *MORE]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], "doc_id long, text string, length long, offset string")
    rows = K.pack(docs.repartition(3), P.path("word_bpe_49k.json"), pool_tokens=3000).collect()
    whole, padded = check_packed(rows, dict(enumerate(texts)), words_of)
    assert whole == padded
    for r in rows:
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]


def test_all_documents_and_balanced_groups(spark, sf_dir, words_of):
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    rows = K.pack(docs, P.path("word_bpe_49k.json"), with_ids=False, group_tokens=1 << 15).collect()
    whole, padded = check_packed(rows, {r["doc_id"]: r["text"] for r in docs.collect()}, words_of)
    assert whole == padded
    cost, tokens = {}, {}
    for r in rows:
        if r["window_tokens"] == 4096:
            cost[r["group_id"]] = cost.get(r["group_id"], 0) + r["length"] ** 2
            tokens[r["group_id"]] = tokens.get(r["group_id"], 0) + r["length"]
    assert len(cost) > 5 and max(tokens.values()) - min(tokens.values()) <= 4096
    assert max(cost.values()) <= 1.5 * sorted(cost.values())[len(cost) // 2]


def test_repeats_null_ids_and_empty(spark):
    rows = K.pack(documents(spark), P.path("word_bpe_49k.json"), with_ids=False).collect()
    assert sum(r["doc_id"] is None for r in rows) == 1 and sum(r["doc_id"] == 4 for r in rows) >= 2
    assert K.pack(documents(spark).limit(0), P.path("word_bpe_49k.json")).count() == 0


def test_word_memory_stays_bounded(words_of):
    coder = K.WordIds(open(P.path("word_bpe_49k.json"), encoding="utf-8").read(), remembered=40)
    for text in [*MORE, LONG[:3000]]:
        assert as_ids(coder.ids(text)) == words_of(text)[:-1]


def test_stops_after_letters_that_end_in_a_mark(words_of):
    coder = K.WordIds(open(P.path("word_bpe_49k.json"), encoding="utf-8").read())
    for text in ["İKİ.", "ANADİLİ, BELEDİYESİ! İyi. iki.", "क़. יִ? xড়!", "Zoë. é, ΑΣ."]:
        assert as_ids(coder.ids(text)) == words_of(text)[:-1], text


ADDED = [
    "<|endoftext|> <|startoftext|>", "a<|endoftext|>B. c <|ENDOFTEXT|>, <|EndOfText|>", "x <|endoftext|>. É<|startoftext|>İ! <|endoftext",
    "J̌<|endoftext|>́ É <|endoftext|><|endoftext|>\n<| endoftext|> don't<|startoftext|>'S", "plain TEXT. without",
]


def test_added_tokens_equal_the_untouched_library(spark, sf_dir, monkeypatch):
    untouched = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    words_of = lambda text: untouched.encode(text or "", add_special_tokens=False).ids + [2]
    coder = K.WordIds(open(P.path("word_bpe_49k.json"), encoding="utf-8").read(), added_tokens=True)
    texts = [*TEXTS, *MORE, *ADDED]
    for text in filter(None, texts):
        assert as_ids(coder.ids(text)) == words_of(text)[:-1], text
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(Q, "load", lambda *_: docs)
    check_packed(Q.op10_packing(spark, sf_dir).collect(), dict(enumerate(texts)), words_of)
    check_packed(pipeline.packed(spark, docs, sf_dir).collect(), dict(enumerate(texts)), words_of)


def test_queries_take_the_ids(spark, sf_dir, monkeypatch, words_of):
    asked, plain = [], K.pack
    monkeypatch.setattr(K, "pack", lambda *a, **k: asked.append(plain(*a, **k)) or asked[-1])
    docs = load(spark, sf_dir, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    check_packed(Q.op10_packing(spark, sf_dir).collect(), texts, words_of)
    rows = pipeline.packed(spark, docs, sf_dir).collect()
    check_packed(rows, texts, words_of)
    for r in rows:
        assert as_ids(r["ids"]) == words_of(texts[r["doc_id"]])[r["start"] : r["start"] + r["length"]]
    assert len(asked) == 2 and all("ids" in d.columns for d in asked)
