"""Joins with an explicit strategy, and guards against the usual wrong results.

A side is broadcast only after it has been measured. Beyond the bound every
operator here falls back to a shuffle, where adaptive execution splits skew.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weftline.operators.windows import carry_last

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
OPEN_LEVEL = 1 << 20  # above every level of a band with two finite ends

_FIXED_WIDTH = {
    T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4,
}


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of one row: fixed widths, and the measured length of variable columns."""
    width = F.lit(0).cast("long")
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        else:
            width = width + _FIXED_WIDTH.get(type(field.dataType), 16)
    return width


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is proven small.

    The rows are counted first, which for a file needs its footers only; the values
    are measured only when the count is within bounds.
    """
    if df.count() > max_rows:
        return False
    return (df.agg(F.sum(_row_bytes(df))).first()[0] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def null_safe(pairs: Sequence[tuple[Column, Column]]) -> Column:
    return reduce(lambda x, y: x & y, [a.eqNullSafe(b) for a, b in pairs])


def broadcast_join(big: DataFrame, small: DataFrame, on: Sequence[str] | Column, how: str = "inner") -> DataFrame:
    on = on if isinstance(on, Column) else list(on)
    return big.join(broadcast_if_small(small), on, how)


def shuffle_hash_join(big: DataFrame, build: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    return big.join(build.hint("shuffle_hash"), list(on), how)


def sort_merge_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    return left.join(right.hint("merge"), list(on), how)


def semi_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` with a partner. Only the distinct keys of ``right`` are shuffled."""
    return left.join(right.select(*on).distinct(), list(on), "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner; rows with a null key have none and are kept."""
    return left.join(right.select(*on).distinct(), list(on), "left_anti")


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """SQL ``NOT IN``: a null on the right rejects every row, a null on the left its own row.

    The null is looked for once and the rest is an anti join, so the plan never
    needs the nested loop of a null-aware comparison.
    """
    keys = right.select(key).distinct()
    seen = keys.agg(F.coalesce(F.bool_or(F.col(key).isNull()), F.lit(False)).alias("has_null"), F.count("*").alias("n"))
    allowed = (seen.select("n").scalar() == 0) | (F.col(key).isNotNull() & ~seen.select("has_null").scalar())
    return anti_join(left, keys, [key]).where(allowed)


def theta_join(big: DataFrame, small: DataFrame, condition: Column, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join on any condition; every row of one side meets every row of the other.

    A small side is broadcast and ``big`` is not shuffled. Otherwise both sides are dealt to a square of
    tiles, each of which meets in one task. Where the condition bounds a value, ``range_join`` does far less.
    """
    if fits(small, max_rows):
        return big.join(F.broadcast(small), condition)
    return _tiled(big, small).where(condition).drop("_i", "_j")


def _tiled(a: DataFrame, b: DataFrame) -> DataFrame:
    """All pairs, as an equi join on tiles: each side is cut into ``n`` parts and copied to the ``n`` parts of the other."""
    n = max(2, math.isqrt(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    part = lambda df: F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = a.withColumn("_i", part(a)).withColumn("_j", every)
    others = b.withColumn("_j", part(b)).withColumn("_i", every)
    return rows.join(others, ["_i", "_j"])


def product(big: DataFrame, small: DataFrame, max_rows: int = 1_000) -> DataFrame:
    """Every row of ``big`` with every row of ``small``.

    A side of up to ``max_rows`` rows becomes one array and is unpacked row by row, without a shuffle or a
    nested loop; a larger one is joined in tiles.
    """
    if not fits(small, max_rows):
        return _tiled(big, small).drop("_i", "_j").select(*big.columns, *small.columns)
    packed = small.agg(F.collect_list(F.struct("*"))).scalar()
    return big.select("*", F.explode(packed).alias("_row")).select(*big.columns, "_row.*")


def safe_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | None,
    how: str = "inner",
    nulls_match: bool = False,
    fold_case: bool = False,
    cast: str | None = None,
) -> DataFrame:
    """Equi join with aligned keys; refuses to become a product.

    ``cast`` brings both sides to one type, ``fold_case`` ignores letter case and
    ``nulls_match`` lets null keys meet. The key columns of the result are those of ``left``, and in a right or
    full join those of ``right`` where there is no left row.
    """
    if not on:
        raise ValueError("a join needs at least one key; use product() for every combination")

    def aligned(column: Column) -> Column:
        column = column.cast(cast) if cast else column
        return F.lower(column) if fold_case else column

    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in on})
    pairs = [(aligned(F.col(k)), aligned(F.col(f"_right_{k}"))) for k in on]
    if nulls_match:
        condition = null_safe(pairs)
    else:
        condition = reduce(lambda x, y: x & y, [a == b for a, b in pairs])
    if how not in ("right", "full", "outer"):
        return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in on])
    # A left row may hold null keys of its own, so its presence is marked rather than guessed.
    joined = left.withColumn("_left", F.lit(True)).join(renamed, condition, how)
    for k in on:
        kind = joined.schema[k].dataType
        joined = joined.withColumn(k, F.when(F.col("_left"), F.col(k)).otherwise(F.col(f"_right_{k}").cast(kind)))
    return joined.drop("_left", *[f"_right_{k}" for k in on])


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], keep: Column | None = None) -> DataFrame:
    """Filter the fact table, then join each ``(dimension, fact key, dimension key)``.

    A dimension whose key is not a column of the fact belongs to another dimension. Such outer dimensions are joined to
    the inner ones first, so that the fact, the largest table, is joined once per dimension of its own. Spark broadcasts
    the sides that are small by their statistics.
    """
    joined = fact if keep is None else fact.where(keep)
    inner: list[tuple[DataFrame, str, str]] = []
    for dim, fact_key, dim_key in reversed(dims):
        for outer in [d for d in inner if d[1] in dim.columns]:
            inner.remove(outer)
            dim = dim.join(outer[0], F.col(outer[1]) == F.col(outer[2])).drop(outer[1], outer[2])
        inner.append((dim, fact_key, dim_key))
    for dim, fact_key, dim_key in reversed(inner):
        joined = joined.join(dim, F.col(fact_key) == F.col(dim_key)).drop(dim_key)
    return joined


def chain(first: DataFrame, *steps: tuple[DataFrame, Callable[[], Column] | Sequence[str]]) -> DataFrame:
    joined = first
    for right, on in steps:
        joined = joined.join(right, on() if callable(on) else list(on))
    return joined


def range_join(points: DataFrame, bands: DataFrame, value: str, lo: str, hi: str, width: float) -> DataFrame:
    """Pairs with ``lo <= value < hi`` by an equi join on bins, no nested loop.

    ``width`` is the usual band length. A band longer than that goes to a level with bins
    twice, four times, ... as wide, so it is listed in three bins at most, however long it
    is. Bands open to infinity share one level with a single bin. A point looks in one bin of each level that is in
    use. Small bands are broadcast and the points stay where they are; otherwise hot bins are split at run time.
    """
    length = F.col(hi).cast("double") - F.col(lo).cast("double")
    open_end = length >= F.lit(float("inf"))
    closed = F.greatest(F.lit(0), F.ceil(F.log2(length / F.lit(width)))).cast("int")
    level = F.when(open_end, F.lit(OPEN_LEVEL)).otherwise(closed)
    wide = lambda c: F.floor(c / (F.lit(width) * F.pow(F.lit(2.0), F.col("_level"))))
    bin_of = lambda c: F.when(F.col("_level") == OPEN_LEVEL, F.lit(0).cast("long")).otherwise(wide(c))
    placed = (
        bands.where(length > 0)
        .withColumn("_level", level)
        .withColumn("_bin", F.explode(F.sequence(bin_of(F.col(lo)), bin_of(F.col(hi)))))
    )
    # A level stands for a power of two of a double, so there are few.
    levels = [r[0] for r in placed.select("_level").distinct().collect()] or [0]
    tagged = points.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in sorted(levels)])))
    tagged = tagged.withColumn("_bin", bin_of(F.col(value)))
    inside = (F.col(value) >= F.col(lo)) & (F.col(value) < F.col(hi))
    return tagged.join(broadcast_if_small(placed), ["_level", "_bin"]).where(inside).drop("_level", "_bin")


def asof_last(
    left: DataFrame,
    right: DataFrame,
    key: str,
    t: str,
    values: dict[str, str],
    tie: Sequence[str] = (),
    max_rows: int | None = None,
) -> DataFrame:
    """For each row of ``left`` the last row of ``right`` with the same key at or before its time.

    ``values`` maps columns of ``right`` to result names. Among rows of the same key and time the last by
    ``tie``, then by the values, counts. A null key or time on either side has no partner. Both sides go through one
    shuffle as a union; a key with too many rows is cut along time.
    """
    facts = F.struct(*[F.col(c).alias(n) for c, n in values.items()])
    known = right.where(F.col(key).isNotNull() & F.col(t).isNotNull())
    marked = known.select(key, t, F.lit(0).alias("_side"), F.struct(*tie, facts.alias("_values")).alias("_tie"), facts.alias("_fact"))
    none = {c: F.lit(None).cast(marked.schema[c].dataType).alias(c) for c in ("_tie", "_fact")}
    rows = left.select(key, t, F.lit(1).alias("_side"), none["_tie"], none["_fact"], F.struct(*left.columns).alias("_left"))
    both = rows.unionByName(marked, allowMissingColumns=True)
    carried = carry_last(both, [key], [t, "_side", "_tie"], "_fact", "_last", max_rows)
    return carried.where(F.col("_side") == 1).select("_left.*", "_last.*")
