"""Detection and handling of skewed keys.

Salts are a function of the row, never random: a task that runs again must send
each row to the same place. The key stays a column of its own and the salt is a
separate integer, so any text may occur in a key. Rows with a null key are kept.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

HOT_ROWS = 10_000_000
HOT_ROWS_CONF = "spark.weftline.hotRows"
SALT = "_salt"


def hot_rows(spark: SparkSession, given: int | None = None) -> int:
    """Rows of one key that a single task may take; larger groups are split."""
    return given or int(spark.conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))


def hot_counts(df: DataFrame, keys: Sequence[str], max_rows: int | None = None) -> dict[int, int]:
    """Hash and rows of every key group above ``max_rows``, largest first.

    One count per key, combined before the shuffle, so neither a task nor the result depends on how
    many keys there are. A listed group has more than ``max_rows`` rows, so what comes back to the
    driver is at most one entry per ``max_rows`` rows of the table.
    """
    limit = hot_rows(df.sparkSession, max_rows)
    counted = df.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count("*").alias("n"))
    hot = counted.where(F.col("n") > limit).collect()
    return {row["h"]: row["n"] for row in sorted(hot, key=lambda row: -row["n"])}


def hot_and_total(df: DataFrame, keys: Sequence[str], max_rows: int | None = None) -> tuple[dict[int, int], int]:
    """``hot_counts`` and the number of all rows, from the same count per key."""
    limit = hot_rows(df.sparkSession, max_rows)
    counted = df.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count("*").alias("n"))
    hot, total = counted.agg(F.collect_list(F.when(F.col("n") > limit, F.struct("h", "n"))), F.sum("n")).first()
    return {row["h"]: row["n"] for row in sorted(hot, key=lambda row: -row["n"])}, total or 0


def hot_groups(df: DataFrame, keys: Sequence[str], max_rows: int | None = None) -> list[int]:
    return list(hot_counts(df, keys, max_rows))


def salts_for(hot: Mapping[int, int], limit: int) -> int:
    """Salts that bring the largest hot key down to the row limit per task."""
    return max(2, math.ceil(max(hot.values(), default=0) / limit))


def in_groups(keys: Sequence[str], hashes: Sequence[int]) -> Column:
    """Whether a row belongs to one of the groups; never null, also for null keys."""
    return F.xxhash64(*keys).isin(list(hashes)) if hashes else F.lit(False)


def salt_of(by: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")


def spread_hot(df: DataFrame, hot: Column, by: Sequence[str], n: int) -> DataFrame:
    return df.withColumn(SALT, F.when(hot, salt_of(by, n)).otherwise(F.lit(0)))


def replicate_hot(df: DataFrame, hot: Column, n: int) -> DataFrame:
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    return df.withColumn(SALT, F.explode(salts))


def salted_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], n: int, salt_by: Sequence[str] | None = None
) -> DataFrame:
    """Inner join with every key of ``big`` spread over ``n`` salts and ``small`` repeated per salt.

    Pass a row id as ``salt_by`` where many rows are identical; by default the whole row is hashed.
    """
    left = big.withColumn(SALT, salt_of(salt_by or big.columns, n))
    right = small.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return left.join(right, [*keys, SALT]).drop(SALT)


def split_skew_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    hot: Column,
    n: int,
    how: str = "inner",
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join normal keys plainly and hot keys with salt, then put the halves together.

    ``hot`` is a predicate over the key columns that is never null, so that each row
    falls in exactly one half. ``how`` names the preserved side as in a plain join of
    ``big`` with ``small``.
    """
    normal = big.where(~hot).join(small.where(~hot), list(keys), how)
    return normal.unionByName(_hot_half(big.where(hot), small.where(hot), keys, n, how, salt_by).select(normal.columns))


def _hot_half(
    big: DataFrame, small: DataFrame, keys: Sequence[str], n: int, how: str, salt_by: Sequence[str] | None
) -> DataFrame:
    """The salted inner join, and the rows without a partner once, unsalted."""
    joined = salted_join(big, small, keys, n, salt_by)
    if how in ("left", "full"):
        alone = big.join(small.select(*keys).distinct(), list(keys), "left_anti")
        joined = joined.unionByName(alone, allowMissingColumns=True)
    if how in ("right", "full"):
        alone = small.join(big.select(*keys).distinct(), list(keys), "left_anti")
        joined = joined.unionByName(alone, allowMissingColumns=True)
    return joined


def outer_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    salt_by: Sequence[str] | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Left, right or full outer join that survives a hot key on either side.

    Adaptive execution can split only the preserved side of an outer join (and neither
    side of a full one). The other side is measured, and its hot keys are joined apart: the rows
    of the side that is hot are spread, those of the other side are copied. ``salt_by`` names columns of
    the side that is not preserved (of ``right`` for a full join).
    """
    rest = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys]
    if how == "right":
        return outer_join(right, left, keys, "left", salt_by, max_rows).select(*keys, *rest)
    limit = hot_rows(left.sparkSession, max_rows)
    in_right = hot_counts(right, keys, max_rows)
    in_left = {h: n for h, n in hot_counts(left, keys, max_rows).items() if n > in_right.get(h, 0)} if how == "full" else {}
    in_right = {h: n for h, n in in_right.items() if h not in in_left}
    if not in_right and not in_left:
        return left.join(right, list(keys), how)
    flipped = {"left": "right", "full": "full"}[how]
    hot_right, hot_left = in_groups(keys, list(in_right)), in_groups(keys, list(in_left))
    normal = ~(hot_right | hot_left)
    parts = [left.where(normal).join(right.where(normal), list(keys), how)]
    if in_right:
        parts.append(_hot_half(right.where(hot_right), left.where(hot_right), keys, salts_for(in_right, limit), flipped, salt_by))
    if in_left:
        parts.append(_hot_half(left.where(hot_left), right.where(hot_left), keys, salts_for(in_left, limit), "full", None))
    return reduce(DataFrame.unionByName, [p.select(*keys, *rest) for p in parts])


# Each entry: what to compute per salted part, and how to put the parts together.
_DECOMPOSE = {
    "sum": (F.sum, F.sum),
    "count": (F.count, F.sum),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
}


def salted_agg(
    df: DataFrame, keys: Sequence[str], n: int, aggs: Mapping[str, tuple[str, str]], salt_by: Sequence[str] | None = None
) -> DataFrame:
    """Aggregate by ``(keys, salt)`` and then by ``keys``.

    ``aggs`` maps a result name to ``(function, column)``; sum, count, min, max and avg
    decompose. ``count`` of ``"*"`` counts rows.
    """
    first, second = [], []
    for name, (fn, column) in aggs.items():
        value = F.lit(1) if column == "*" else F.col(column)
        if fn == "avg":
            first += [F.sum(value).alias(f"{name}_s"), F.count(value).alias(f"{name}_c")]
            second.append((F.sum(f"{name}_s") / F.sum(f"{name}_c")).alias(name))
        else:
            partial, final = _DECOMPOSE[fn]
            first.append(partial(value).alias(name))
            second.append(final(name).alias(name))
    salted = df.withColumn(SALT, salt_of(salt_by or df.columns, n))
    return salted.groupBy(*keys, SALT).agg(*first).groupBy(*keys).agg(*second)


def split_skew_agg(
    df: DataFrame,
    keys: Sequence[str],
    hot: Column,
    n: int,
    aggs: Mapping[str, tuple[str, str]],
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Aggregate normal keys in one step and hot keys in two; a key is in exactly one half."""
    plain = []
    for name, (fn, column) in aggs.items():
        value = F.lit(1) if column == "*" else F.col(column)
        plain.append(getattr(F, fn)(value).alias(name))
    normal = df.where(~hot).groupBy(*keys).agg(*plain)
    return normal.unionByName(salted_agg(df.where(hot), keys, n, aggs, salt_by))


def salted_repartition(df: DataFrame, keys: Sequence[str], hot: Column, n: int, salts: int, by: Sequence[str]) -> DataFrame:
    """Shuffle by key, with the rows of hot keys spread over ``salts`` more places."""
    return spread_hot(df, hot, by, salts).repartition(n, *keys, SALT).drop(SALT)


def key_skew(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent keys with share of all rows, ratio to the mean, and a flag above half."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    # Counting rows reads no column; the number of keys reuses the shuffle of the counts.
    total, groups = df.agg(F.count("*")).scalar(), counts.agg(F.count("*")).scalar()
    share = F.col("n") / total
    return (
        counts.select(
            *keys,
            "n",
            share.alias("share"),
            (F.col("n") * groups / total).alias("ratio"),
            (share > 0.5).alias("dominant"),
        )
        .orderBy(F.desc("n"), *keys)
        .limit(k)
    )


def hot_keys(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Keys that hold more than ``share`` of all rows: at most ``1/share`` of them."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > df.agg(F.count("*")).scalar() * F.lit(share))


def hot_predicate(df: DataFrame, key: str, share: float) -> Column:
    """``hot_keys`` as a never-null predicate on ``key``; the list is bounded by ``1/share``."""
    found = [row[key] for row in hot_keys(df, [key], share).collect()]
    hot = F.coalesce(F.col(key).isin([v for v in found if v is not None]), F.lit(False))
    return hot | F.col(key).isNull() if None in found else hot


def _with_empty(counted: DataFrame, partitions: int) -> DataFrame:
    every = counted.sparkSession.range(partitions).select(F.col("id").cast("int").alias("part"))
    return every.join(counted, "part", "left").select("part", F.coalesce("n", F.lit(0)).alias("n"))


def partition_sizes(df: DataFrame, partitions: int) -> DataFrame:
    """Rows in each physical partition, the empty ones included."""
    return _with_empty(df.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")), partitions)


def partition_skew(sizes: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Smallest, largest and mean partition; skewed when the largest is over ``threshold`` times the mean."""
    sizes = sizes.agg(
        F.count("*").alias("partitions"),
        F.count(F.when(F.col("n") == 0, 1)).alias("empty"),
        F.min("n").alias("min_rows"),
        F.max("n").alias("max_rows"),
        F.sum("n").alias("rows"),
    )
    ratio = F.col("max_rows") * F.col("partitions") / F.nullif("rows", F.lit(0))
    return sizes.select("*", ratio.alias("ratio"), F.coalesce(ratio > threshold, F.lit(False)).alias("skewed"))
