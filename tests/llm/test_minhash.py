from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import LONG, TEXTS
from weftline.llm import minhash_tensor as M
from weftline.sources.tables import load


def plain_set(text, k):
    found = (text or "").encode().lower().split()
    if not found:
        return frozenset()
    size = min(k, len(found))
    return frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1))


def brute(rows, scheme):
    """doc -> (set sizes, component) by comparing all pairs."""
    sets = [(d, plain_set(t, scheme.words)) for d, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, sa) in enumerate(sets):
        for b, sb in sets[:i]:
            if a is None or b is None or not sa or not sb:
                continue
            both = len(sa & sb)
            if 100 * both >= scheme.percent * (len(sa) + len(sb) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted(((d, len(s), root(d) if d is not None else None, d is None or root(d) == d) for d, s in sets), key=repr)


def got(spark, rows, scheme):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, component string, n long")
    return sorted((tuple(r) for r in M.near_duplicates(frame, scheme).collect()), key=repr)


def edited(words, changes, rng):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    prose = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    shared, texts = prose(60), []
    for _ in range(12):  # a source with copies of many distances
        base = prose(rng.randrange(30, 300))
        texts += [edited(base, rng.randrange(0, max(2, len(base) // 12)), rng) for _ in range(rng.randrange(1, 9))]
    chain = prose(200)
    for _ in range(6):  # each like the one before, the ends unlike
        texts.append(" ".join(chain))
        chain = edited(chain, 5, rng).split()
    star = prose(300)
    texts += [" ".join(star)] + [edited(star, 8, rng) for _ in range(90)]
    texts += [" ".join(prose(20) + shared + prose(rng.randrange(10, 60))) for _ in range(80)]
    texts += [" ".join(prose(rng.randrange(1, 5))) for _ in range(30)] + ["Same Words", "same words", "other same words"] * 2
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, scheme", [(1, M.Scheme(words=3, percent=85)), (2, M.Scheme())])
def test_components_equal_all_pairs(spark, seed, scheme):
    rows = corpus(seed)
    assert got(spark, rows, scheme) == brute(rows, scheme)


def test_documents_equal_all_pairs(spark, sf_dir):
    scheme = M.Scheme(words=3, percent=85)
    rows = [(r["doc_id"], r["text"]) for r in load(spark, sf_dir, "documents").collect()]
    assert got(spark, rows, scheme) == brute(rows, scheme)


def test_large_neighbourhoods_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(M, "TILE_SHINGLES", 3_000)
    rows, scheme = corpus(3), M.Scheme(words=3, percent=85)
    assert got(spark, rows, scheme) == brute(rows, scheme)


def test_odd_rows(spark):
    scheme = M.Scheme()
    rows = [(i if i != 3 else None, t) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4]), (None, LONG), (20, LONG + " end"), (1, "one two three")]
    rows = [(d, t) for d, t in rows if d != 1] + [(None, None)]
    assert got(spark, rows, scheme) == brute(rows, scheme)


def test_rows_that_repeat_an_id_are_one_document(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(7, a), (7, b), (9, b), (8, a), (5, "something else entirely here now")]
    assert [(d, c, k) for d, _, c, k in got(spark, rows, M.Scheme())] == [(5, 5, True), (7, 7, True), (7, 7, True), (8, 7, False), (9, 7, False)]


def test_empty_table(spark):
    assert got(spark, [], M.Scheme()) == []


def test_scheme_keeps_its_promise():
    for scheme in (M.Scheme(), M.Scheme(words=3, percent=85), M.Scheme(percent=50, tuple_size=2)):
        hit = 1 - (1 - (scheme.percent / 100) ** scheme.tuple_size) ** scheme.tuples
        assert 1 - hit * hit <= scheme.miss * 1.01


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(100, 200 + i) for i in range(50)]
    got = M.components(spark.createDataFrame([*chain, *star, (500, 500)], "a long, b long")).collect()
    want = {i: 1 for i in range(2, 61)} | {200 + i: 100 for i in range(50)}
    assert {r["doc"]: r["component"] for r in got if r["doc"] != r["component"]} == want


def test_hubs_of_any_size_keep_their_component(spark):
    """Two stars whose hubs have the largest and the smallest id, joined by one link, beside many pairs."""
    low, high = [(0, i) for i in range(1, 400)], [(9_000, i) for i in range(1_000, 1_400)]
    pairs = [(i, i + 1) for i in range(2_000, 2_600, 2)]
    frame = spark.createDataFrame([*low, *high, (399, 1_000), *pairs, *high], "a long, b long")
    assert M._fair_share(spark, 2 * frame.count()) < 399
    got = {r["doc"]: r["component"] for r in M.components(frame).collect()}
    want = {i: 0 for i in [*range(1, 400), *range(1_000, 1_400), 9_000]} | {i + 1: i for i in range(2_000, 2_600, 2)}
    assert {d: c for d, c in got.items() if d != c} == want


def test_arcs_of_hubs_are_not_shuffled_by_node(spark):
    arcs = spark.createDataFrame([(i % 3 and i, i) for i in range(300)], "u long, v long")
    least = arcs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    got = M._with_least(arcs, least, 50)
    assert sorted(map(tuple, got.collect())) == sorted((i % 3 and i, i, i % 3 and i) for i in range(300))
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
