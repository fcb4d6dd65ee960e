"""Token alignment against the tokenizers' own ids and plain Python, and the laws of the fragments."""

from __future__ import annotations

import random
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.llm.cases import TEXTS
from weftline.llm import queries, token_align as T
from weftline.sources.tables import load

FILES = T.Tokenizers.read(P.path("byte_bpe_50k.json"), P.PATTERN, P.path("piece_bpe_32k.model"))
ODD = [
    "a▁b", "<|endoftext|> <s></s> <unk> <0x41>", "  two  spaces  ", " ", "\n\n", "tab\tline\r\n x", "\x00\x01 \x85  z", "中文 字", "ﬁ ℌ",
    "ends with blanks   ", "don't  we'LL 123456 $$$ ...", " nb  sp", "x" * 700, "🦆" * 50 + " é" * 40,
]


@cache
def libraries():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model")), T.Speller(FILES)


def tokens(text):
    a, b, spell = libraries()
    if not text:
        return [], []
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    spelt = [b"".join(spell.a_bytes[i] for i in x), b"".join(spell.b_bytes[i] for i in y)]
    return (x, y) if spelt == [(" " + text).encode()] * 2 else ([], [])


def groups_and_links(a, b):
    """Plain two-pointer walk over the tokens."""
    spell = libraries()[2]
    groups, links, i, j, x, y = [], [], 0, 0, 0, 0
    xs, ys = [], []
    while i < len(a) or j < len(b):
        if x <= y:
            xs.append((a[i], x, x + len(spell.a_bytes[a[i]])))
            x, i = xs[-1][2], i + 1
        else:
            ys.append((b[j], y, y + len(spell.b_bytes[b[j]])))
            y, j = ys[-1][2], j + 1
        if x == y:
            groups.append(([t for t, _, _ in xs], [t for t, _, _ in ys]))
            links += [(s, t) for s, s0, s1 in xs for t, t0, t1 in ys if s0 < t1 and t0 < s1]
            xs, ys = [], []
    return groups, links


def brute(rows):
    found = [(doc, *tokens(text)) for doc, text in rows]
    each = [(doc, a, b, *groups_and_links(a, b)) for doc, a, b in found]
    counts = Counter(pair for *_, links in each for pair in links)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    text = lambda groups: ";".join("|".join(",".join(map(str, s)) for s in g) for g in groups)
    return sorted(
        (
            (doc, len(a), len(b), len(g), len(ls), sum(counts[p] == best[p[1]] for p in ls), sum(counts[p] for p in ls), text(g))
            for doc, a, b, g, ls in each
        ),
        key=repr,
    )


def got(spark, rows, **kw):
    frame = spark.createDataFrame([(d, t, 1, "x", b"y") for d, t in rows], "doc_id long, text string, row int, groups string, a binary")
    return sorted((tuple(r) for r in T.align(frame, FILES, **kw).collect()), key=repr)


def table():
    texts = [t[:20_000] if t else t for t in TEXTS] + ODD
    rows = [(i if t != "one" else None, t) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[-1], (None, ODD[3])]


@pytest.mark.parametrize("kw", [{}, {"range_bytes": 7, "fan": 2}, {"range_bytes": 500, "fan": 3, "most_pairs": 50}])
def test_same_as_plain_python(spark, kw):
    rows = table()
    if kw.get("range_bytes") == 7:  # very many ranges
        rows = [(d, t[:900] if t else t) for d, t in rows]
    want = brute(rows)
    assert got(spark, rows, **kw) == want and sum(r[3] for r in want) > 1000


@pytest.mark.parametrize("kw", [{}, {"range_bytes": 2000}])
def test_documents(spark, sf_dir, kw):
    docs = load(spark, sf_dir, "documents")
    found = sorted((tuple(r) for r in T.align(docs, FILES, **kw).collect()), key=repr)
    assert found == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_query_has_the_digest(spark, sf_dir):
    import hashlib

    want = {r[0]: r[-1] for r in brute([(r["doc_id"], r["text"]) for r in load(spark, sf_dir, "documents").collect()])}
    found = {r["doc_id"]: r["groups_sha256"] for r in queries.op11_token_align(spark, sf_dir).collect()}
    assert found == {d: hashlib.sha256(t.encode()).hexdigest() if t else "" for d, t in want.items()}


def test_empty_table(spark):
    assert got(spark, []) == [] and got(spark, [(1, None), (2, ""), (3, "▁")]) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_memory_does_not_change_ids(monkeypatch):
    spell = T.Speller(FILES)
    texts = [*ODD, " ".join(ODD), TEXTS[-1][:30_000], "x  y   z " * 200, " a b  c\n d\t e f" * 50]
    want = [tokens(t) for t in texts]
    for limit, short in ((0, 48), (40, 3), (10**6, 0)):
        spell.known.limit = limit
        monkeypatch.setattr(T, "SHORT", short)
        for _ in range(2):
            assert [(a.tolist(), b.tolist()) for a, b in spell.encode(texts)] == want
            assert [tuple(map(list, spell.encode([t])[0])) for t in texts] == want


def test_ids_of_any_code_point():
    rng = random.Random(3)
    texts = ["".join(chr(rng.choice([rng.randrange(1, 0x3000), rng.randrange(32, 127), rng.randrange(0xE000, 0x11000), 32])) for _ in range(20)) for _ in range(4000)]
    assert [(a.tolist(), b.tolist()) for a, b in libraries()[2].encode(texts)] == [tokens(t) for t in texts]


def random_ranges(rng, size):
    """Token ends of two tokenizations of the same bytes, cut into ranges."""
    total = rng.randrange(1, 60)
    ends = [sorted({total, *(rng.randrange(1, total + 1) for _ in range(rng.randrange(0, 30)))}) for _ in range(2)]
    ids = [[rng.randrange(100) for _ in e] for e in ends]
    out = []
    for place in range(-(-total // size)):
        part = []
        for i, e in zip(ids, ends):
            here = [k for k, end in enumerate(e) if place * size < end <= (place + 1) * size]
            part += [np.array([i[k] for k in here], np.int64), np.array([e[k] for k in here], np.int64)]
        out.append(T.fragment(place, *part))
    return ids, ends, out


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**9), st.sampled_from([1, 2, 5, 9]))
def test_fragments_are_a_monoid(seed, size):
    rng = random.Random(seed)
    ids, ends, parts = random_ranges(rng, size)
    whole = sum(parts, T.Fragment())
    for _ in range(4):  # any bracketing gives the same
        left = list(parts)
        while len(left) > 1:
            i = rng.randrange(len(left) - 1)
            left[i : i + 2] = [left[i] + left[i + 1]]
        assert left[0] == whole
    assert T.Fragment() + whole == whole == whole + T.Fragment()
    runs = [(2 * whole.place, whole.prefix.a, whole.prefix.b), *whole.runs]
    assert whole.suffix == T.Open() and [p for p, *_ in runs] == sorted({p for p, *_ in runs})
    for k in (0, 1):
        assert [t for run in runs for t in run[k + 1]] == ids[k]
    # Every run ends at a common end.
    a = b = 0
    for _, x, y in runs:
        a, b = a + len(x), b + len(y)
        assert ends[0][a - 1] == ends[1][b - 1]
