"""Line removal against plain Python, and the perfect hash against a dictionary."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.cases import TEXTS
from weftline.llm import line_dedup as L
from weftline.sources.tables import load

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return line.strip(" \t\n\v\f\r").translate(LOWER)


def brute(rows, policy):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key_of(line)) >= policy.least_chars:
                holders[key_of(line)].add(doc)
    keeper = {k: max(docs) for k, docs in holders.items() if len(docs) >= policy.least_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key_of(x) not in keeper or keeper[key_of(x)] == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def got(spark, rows, policy, **kw):
    frame = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, high string, n_lines int, row int")
    return sorted((tuple(r) for r in L.drop_repeated_lines(frame, policy, **kw).collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    shared = [f"Shared line {i} " + "é" * (i % 40) + " and so on" for i in range(60)]
    rows = [(i if t != "one" else None, t) for i, t in enumerate(TEXTS)]
    for i in range(120):
        lines = rng.sample(shared, rng.randrange(0, 9)) + [f"own {i} " + "z" * rng.randrange(60)]
        lines = [rng.choice([x, x.upper(), f" \t{x}\v ", x + "\r"]) for x in lines] * rng.choice([1, 1, 2])
        rng.shuffle(lines)
        rows.append((rng.choice([None, i % 90, i + 1000]), "\n".join(lines)))
    return rows + rows[30:40]


PATHS = [{}, {"shard_keys": 3}, {"most_bytes": 0, "shard_keys": 4, "probes": 10}]


@pytest.mark.parametrize("kw", PATHS)
@pytest.mark.parametrize("policy", [L.Policy(20, 3), L.Policy(40, 5), L.Policy(1, 1)])
def test_same_as_plain_python(spark, kw, policy):
    rows = corpus(policy.least_docs)
    want = brute(rows, policy)
    assert got(spark, rows, policy, **kw) == want
    assert policy.least_docs == 5 or any(r[3] for r in want)


@pytest.mark.parametrize("kw", PATHS)
def test_documents(spark, sf_dir, kw):
    docs = load(spark, sf_dir, "documents")
    found = sorted((tuple(r) for r in L.drop_repeated_lines(docs, **kw).collect()), key=repr)
    assert found == brute([(r["doc_id"], r["text"]) for r in docs.collect()], L.Policy())


def test_a_common_line_among_very_many_rows(spark):
    rows = [(i, "the same line in all of the documents of this table\nline " + str(i)) for i in range(3000)]
    rows += [(None, rows[0][1])] * 50
    for kw in PATHS:
        assert got(spark, rows, L.Policy(), **kw) == brute(rows, L.Policy())


@pytest.mark.parametrize("kw", PATHS)
def test_empty_table(spark, kw):
    assert got(spark, [], L.Policy(), **kw) == []


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 40_000])
def test_perfect_hash(n, monkeypatch):
    rng = np.random.default_rng(n)
    high, low = rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.integers(0, 1 << 63, n, dtype=np.uint64)
    for levels in (L.LEVELS, 2):  # with two levels many hashes are listed
        monkeypatch.setattr(L, "LEVELS", levels)
        built = L.PerfectHash(high, low)
        again = L.PerfectHash.load(built.saved())
        for hashed in (built, again):
            assert sorted(hashed.slots(high, low).tolist()) == list(range(n))
        assert (again.slots(high, low) == built.slots(high, low)).all()


def test_strangers_are_told_apart():
    rng = np.random.default_rng(7)
    high, low, more = (rng.integers(0, 1 << 63, 5000, dtype=np.uint64) for _ in range(3))
    docs, keeper = np.arange(5000, dtype=np.uint32), np.arange(5000) * 3
    shard = L.Shard(L.Shard.build(high, low, docs, keeper))
    known, kept = shard.find(high, low)
    assert known.all() and (kept == keeper).all()
    assert not shard.find(high, more)[0].any() and not shard.find(more, more)[0].any()
