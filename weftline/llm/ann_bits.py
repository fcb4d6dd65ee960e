"""Nearest neighbours with randomly rotated one-bit codes.

A vector is centred, rotated into ``bits`` dimensions and kept as the signs, packed into 64-bit words, with two correction
scalars: its distance to the centre and the inner product of the signs with the direction they stand for. A query's
direction is rotated likewise and rounded to a few bits; AND and popcount over the packed words then estimate the inner
product, and a bound on the error of the estimate gives a lower and an upper bound on each distance. Only vectors whose lower
bound does not exceed the k-th smallest upper bound are reranked by the exact distance in double precision.

Queries meet all vectors block by block: vectors and queries are dealt to blocks, and each pair of blocks is one
group of bounded size. Equal vectors are one entry that carries its ``k + 1`` smallest ids, more cannot be among
k nearest, so a vector that a third of the rows share costs no more than any other.

Cases: rows whose id is null and vectors that are null, empty, zero, or hold null or non-finite components take no part.
If an id repeats, the least of its vectors (in array order) stands for it. Vectors meet only queries of their own length. Ties go
to the smaller id. An empty table has no neighbours. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.llm.workers import once_per_worker
from weftline.session import materialise

BITS = 256
QUERY_BITS = 6
#: Width of the error bound in standard deviations: 3 leaves out a true neighbour about once in a thousand estimates.
WIDTH = 3.0
VECTOR_BLOCK, QUERY_BLOCK = 8192, 2048


def usable(vector: str) -> Column:
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def rotation(dim: int, bits: int, seed: int):
    """Rows are orthonormal directions of the larger space, restricted to the first ``dim`` axes."""
    import numpy as np

    square = np.random.default_rng(seed).standard_normal((max(bits, dim), max(bits, dim)))
    return np.linalg.qr(square)[0][:, :dim]


def words_for(dim: int, bits: int) -> int:
    return -(-max(bits, dim) // 64)


def encode(vectors, centre, turn):
    """Packed signs, distance to the centre, and inner product of the signs with the direction, of each row."""
    import numpy as np

    moved = vectors - centre
    norm = np.linalg.norm(moved, axis=1)
    turned = (moved / np.where(norm > 0, norm, 1)[:, None]) @ turn.T
    width = turned.shape[1]
    align = np.abs(turned).sum(axis=1) / np.sqrt(width)
    signs = np.zeros((len(vectors), -(-width // 64) * 64), bool)
    signs[:, :width] = turned > 0
    return np.packbits(signs, axis=1, bitorder="little").view("<u8"), norm, np.where(norm > 0, align, 1.0)


def bounds(query, centre, turn, codes, ones, norm, align, width_factor=WIDTH, query_bits=QUERY_BITS):
    """Lower and upper bounds on the squared distances of one query to the coded vectors."""
    import numpy as np

    moved = query - centre
    far = np.linalg.norm(moved)
    unit = turn @ (moved / far if far > 0 else moved)
    bits = len(unit)
    low, step = unit.min(), (unit.max() - unit.min()) / ((1 << query_bits) - 1) or 1.0
    levels = np.rint((unit - low) / step).astype(np.uint64)
    rounded = low + step * levels
    planes = np.zeros((query_bits, codes.shape[1] * 64), bool)
    planes[:, :bits] = (levels[None] >> np.arange(query_bits, dtype=np.uint64)[:, None]) & np.uint64(1)
    planes = np.packbits(planes, axis=1, bitorder="little").view("<u8")
    met = np.bitwise_count(codes[:, None, :] & planes[None]).sum(axis=2, dtype=np.int64)
    dot = (2 * (step * (met @ (1 << np.arange(query_bits))) + low * ones) - rounded.sum()) / np.sqrt(bits)
    error = width_factor * (
        np.sqrt(np.maximum(1 - align**2, 0) / max(bits - 1, 1)) + np.linalg.norm(unit - rounded) / np.sqrt(bits)
    )
    base, scale = norm**2 + far**2, 2 * norm * far / align
    slack = 1e-9 * (1 + base)
    return base - scale * (dot + error) - slack, base - scale * (dot - error) + slack


def exact_distances(query, vectors):
    """Euclidean distances, components added in order, so that equal vectors give equal sums everywhere."""
    import numpy as np

    total = np.zeros(len(vectors))
    for d in range(vectors.shape[1]):
        total += np.square(vectors[:, d] - query[d])
    exact = np.sqrt(total)
    far = np.flatnonzero(~np.isfinite(exact))
    if len(far):  # squares beyond the range of doubles: lengths in units of the largest difference, halved so that it is finite
        halves = np.abs(vectors[far] / 2 - np.asarray(query) / 2)
        unit = halves.max(axis=1)
        exact[far] = np.sqrt(np.square(halves / unit[:, None]).sum(axis=1)) * unit * 2
    return exact


def nearest_in_block(query_id, query, entries, k: int, centre, turn):
    """(id, distance) of the k nearest of one block, ties to the smaller id."""
    import numpy as np

    vectors, ids, codes, ones, norm, align = entries
    if len(vectors) > k + 1:
        low, high = bounds(query, centre, turn, codes, ones, norm, align)
        # One entry may be the query's own. Bounds that overflowed to no number exclude nothing.
        chosen = np.flatnonzero(~(low > np.partition(high, k)[k]))
    else:
        chosen = np.arange(len(vectors))
    exact = exact_distances(query, vectors[chosen])
    best = [(d, i) for d, c in zip(exact.tolist(), chosen.tolist()) for i in ids[c] if i != query_id]
    return sorted(best)[:k]


def _centres(vectors: DataFrame) -> dict[int, list[float]]:
    """The mean vector of each length; sums are formed per component, so no task sees more than its rows."""
    means = (
        vectors.select(F.size("v").alias("dim"), F.posexplode("v").alias("at", "x"))
        .groupBy("dim", "at")
        .agg(F.avg("x").alias("mean"))
        .groupBy("dim")
        .agg(F.sort_array(F.collect_list(F.struct("at", "mean"))).alias("means"))
        .collect()
    )
    return {r["dim"]: [m["mean"] for m in r["means"]] for r in means}


def nearest(
    table: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector: str = "embedding",
    bits: int = BITS, seed: int = 11, vector_block: int = VECTOR_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest other rows of every row that satisfies ``is_query``."""
    spark = table.sparkSession
    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asks"))
    single = rows.where(F.col("id").isNotNull() & usable("v")).groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
    single = materialise(single, "ann-rows")
    centres = _centres(single)
    if not centres:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(centres)  # one vector per length

    first_ids = Window.partitionBy("v").orderBy("id")
    entries = (
        single.select("id", "v")
        .withColumn("nth", F.row_number().over(first_ids))
        .where(F.col("nth") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    coded = materialise(
        entries.mapInArrow(_coder(shared, bits, seed), "v array<double>, ids array<bigint>, codes binary, norm double, align double"),
        "ann-codes",
    )
    asked = single.where("asks").select(F.col("id").alias("query_id"), "v")
    v_blocks, q_blocks = (-(-max(f.count(), 1) // size) for f, size in ((coded, vector_block), (asked, query_block)))
    deal = lambda n: F.pmod(F.xxhash64("v"), F.lit(n)).cast("int")
    to_all = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = coded.select("*", F.size("v").alias("dim"), deal(v_blocks).alias("vb"), to_all(q_blocks).alias("qb"))
    # Queries are dealt by id: equal query vectors are many rows, and each row is a query of its own.
    right = asked.select(
        "*", F.size("v").alias("dim"), F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int").alias("qb"), to_all(v_blocks).alias("vb")
    )
    keys = ["dim", "vb", "qb"]
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(_searcher(shared, bits, seed, k), "query_id bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _turn(dim: int, bits: int, seed: int):
    return once_per_worker(f"rotation of {dim}", (bits, seed), lambda: rotation(dim, bits, seed))


def _matrix(column, dim: int):
    import numpy as np

    return np.asarray(column.combine_chunks().flatten(), float).reshape(-1, dim)


def _coder(shared, bits: int, seed: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            sizes = np.diff(np.asarray(batch.column("v").offsets))
            for dim in np.unique(sizes).tolist():
                part = table.filter(pa.array(sizes == dim))
                codes, norm, align = encode(_matrix(part["v"], dim), np.array(shared.value[dim]), _turn(dim, bits, seed))
                part = part.append_column("codes", pa.array([c.tobytes() for c in codes], pa.binary()))
                part = part.append_column("norm", pa.array(norm)).append_column("align", pa.array(align))
                yield from part.to_batches()

    return run


def _searcher(shared, bits: int, seed: int, k: int):
    def run(entries, queries):
        import numpy as np
        import pyarrow as pa

        out = []
        if entries.num_rows and queries.num_rows:
            dim = queries["dim"][0].as_py()
            codes = np.frombuffer(b"".join(entries["codes"].to_pylist()), "<u8").reshape(-1, words_for(dim, bits))
            ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
            block = (
                _matrix(entries["v"], dim), entries["ids"].to_pylist(), codes, ones,
                np.asarray(entries["norm"]), np.asarray(entries["align"]),
            )
            centre, turn = np.array(shared.value[dim]), _turn(dim, bits, seed)
            for query_id, query in zip(queries["query_id"].to_pylist(), _matrix(queries["v"], dim)):
                out += [(query_id, i, d) for d, i in nearest_in_block(query_id, query, block, k, centre, turn)]
        q, i, d = zip(*out) if out else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(d, pa.float64())})

    return run
