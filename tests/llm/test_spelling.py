"""Spelling variants against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.cases import TEXTS
from weftline.llm import spelling as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()), key=repr)


def got(spark, counts, **kw):
    frame = spark.createDataFrame([(w, n, 0, "x") for w, n in counts], "word string, n long, id int, h string")
    return sorted((tuple(r) for r in S.group_variants(frame, **kw).collect()), key=repr)


def vocabulary(seed, size=250):
    rng = random.Random(seed)
    letters, words = "abcé" if seed % 2 else "abcdefgàÿ", {}
    while len(words) < size:
        base = "".join(rng.choice(letters) for _ in range(rng.choice([1, 3, 7, 8, 12, 40])))
        words[base] = rng.choice([1, 2, 5, 30, 400, 5000])
        for _ in range(rng.randrange(4)):
            i, c = rng.randrange(len(base) + 1), rng.choice(letters)
            for w in (base[:i] + base[i + 1 :], base[:i] + c + base[i:], base[:i] + c + base[i + 1 :]):
                words.setdefault(w, rng.choice([1, 2, 20, 300, 3000]))
    return words


@pytest.mark.parametrize("seed", range(4))
def test_same_as_plain_python(spark, seed):
    words = vocabulary(seed)
    want = brute(words)
    assert got(spark, list(words.items())) == want
    assert any(w[1] and w[2] != w[1] for w in want)  # a form that has a form itself


def test_windows_of_the_filter_and_chunks_of_edits(spark, monkeypatch):
    words = vocabulary(9) | {"q" * 300: 3, "q" * 299: 40, "q" * 298 + "z": 4, "é" * 500 + "x": 2, "é" * 500: 2, "🦆a": 1, "🦆b": 20, "": 2, "a": 50}
    assert got(spark, list(words.items())) == brute(words)
    monkeypatch.setattr(S, "PIECE_BLOCKS", 16)
    assert got(spark, list(words.items()), most_blocks=32) == brute(words)


def test_every_edit_of_a_word_is_generated_once():
    letters = np.array(sorted(map(ord, "abé")), np.uint32)
    for together in (S.TOGETHER, 4):
        before, S.TOGETHER = S.TOGETHER, together
        for word in ("abba", "éaaab", "b"):
            points = np.frombuffer((word * 1).encode("utf-32-le"), "<u4").reshape(1, -1)
            found = [h for _, hashed, _ in S.edits(points, letters, lambda n: True) for h in hashed.tolist()]
            want = {word[:i] + word[i + 1 :] for i in range(len(word))}
            want |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in "abé" if c > word[i]}
            assert sorted(found) == sorted(S.hashes(sorted(want)).tolist())
        S.TOGETHER = before


def test_repeated_null_and_empty(spark):
    frame = [("tower", 3), ("towers", 20), ("tower", 4), (None, 9), ("zero", 0), ("towers", None), ("towers", 60)]
    assert got(spark, frame) == [("tower", "towers", "towers", 7, 1, 80), ("towers", None, "towers", 80, 1, None)]
    assert got(spark, []) == []


def test_words_of_texts(spark):
    texts = [*TEXTS, "ÀÉÎabcd×÷ Straße straße STRASSE anticonstitutionnellement x1abcdefgh2y", "abcdefg " * 40]
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts)] * 3
    want = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            want[run] += 1
    frame = spark.createDataFrame([(d, t, 1, "n") for d, t in rows], "doc_id long, text string, doc int, n string")
    found = {r["word"]: r["n"] for r in S.count_words(frame, 7, S.lost_letter, least=2).collect()}
    assert found == {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    plain = {r["word"]: r["n"] for r in S.count_words(frame, 1).collect()}
    runs = Counter(x.translate(LOWER) for _, t in rows for x in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    assert plain == runs
