from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from weftline.llm import ann_bits as A
from weftline.sources.tables import load

SHAPE = "vec_id long, embedding array<float>, ids string, v string"


def brute(rows, asks, k=10):
    ok = [
        (i, [float(np.float32(x)) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    least = {}
    for i, v in ok:
        least[i] = min(v, least.get(i, v))
    out = []
    for q, qv in least.items():
        if asks(q):
            near = []
            for i, v in least.items():
                if i != q and len(v) == len(qv):
                    total = 0.0
                    for x, y in zip(v, qv):
                        total += (x - y) * (x - y)
                    near.append((math.sqrt(total), i))
            out += [(q, r, i, d) for r, (d, i) in enumerate(sorted(near)[:k], 1)]
    return sorted(out)


def got(spark, rows, asks, **more):
    frame = spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], SHAPE)
    return sorted(tuple(r) for r in A.nearest(frame, asks, **more).collect())


def test_all_neighbours_of_clustered_vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(10, 64))
    rows = [(i, (centres[i % 10] + rng.normal(size=64) * 0.7).tolist()) for i in range(3000)]
    want = brute(rows, lambda i: i % 100 == 0)
    found = got(spark, rows, F.col("vec_id") % 100 == 0, vector_block=700, query_block=8)
    both = {(q, i) for q, _, i, _ in want} & {(q, i) for q, _, i, _ in found}
    assert len(found) == len(want) and len(both) >= 0.99 * len(want)


def test_recall_on_the_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in load(spark, "/root/testdata/sf0.01", "embeddings").collect()]
    assert got(spark, rows, F.col("vec_id") % 100 == 0) == brute(rows, lambda i: i % 100 == 0)


def test_odd_vectors_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0])]
    rows += [(None, [1.0, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [2.0, 0.0]), (9, [0.5, 0.0]), (10, [1.0, 2.0, 3.0])]
    rows += [(100 + i, [1.0, 0.0]) for i in range(30)] + [(200, [3.0, 4.0, 5.0])]
    asks = lambda i: i % 100 == 0
    assert got(spark, rows, F.col("vec_id") % 100 == 0) == brute(rows, asks)


def test_few_and_no_vectors(spark):
    assert got(spark, [(0, [1.0]), (1, [2.0])], F.col("vec_id") == 0) == [(0, 1, 1, 1.0)]
    assert got(spark, [(0, [1.0])], F.col("vec_id") == 0) == []
    assert got(spark, [], F.col("vec_id") == 0) == []


def test_few_vectors_are_reranked(spark):
    """The bounds leave most vectors out, and they hold."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(4000, 64))
    centre, turn = vectors.mean(axis=0), A.rotation(64, 256, 1)
    codes, norm, align = A.encode(vectors, centre, turn)
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    kept, inside = [], []
    for q in vectors[:20]:
        low, high = A.bounds(q, centre, turn, codes, ones, norm, align)
        true = ((vectors - q) ** 2).sum(axis=1)
        inside.append(((low <= true) & (true <= high)).mean())
        kept.append((low <= np.partition(high, 10)[10]).mean())
    assert np.mean(inside) > 0.99 and np.mean(kept) < 0.5


def test_doubles_whose_squares_overflow(spark):
    """Neighbours and distances stay right where squared lengths are beyond the range of doubles."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=16) * 1e200).tolist()) for i in range(300)] + [(i, rng.normal(size=16).tolist()) for i in range(300, 600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = A.nearest(frame, F.col("vec_id") % 100 == 0, vector_block=200).collect()
    vectors = dict(rows)
    for q in range(0, 600, 100):
        far = {i: math.dist(vectors[q], v) for i, v in rows if i != q}  # scaled by the library itself
        want = sorted(far, key=lambda i: (far[i], i))[:10]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [i for _, i, _ in mine] == want
        assert all(math.isclose(s, far[i], rel_tol=1e-12) for _, i, s in mine)
