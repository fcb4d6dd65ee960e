"""Event-time windows, de-duplication and joins of streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weftline.operators.joins import broadcast_if_small


def _flat(grouped: DataFrame, window: str) -> DataFrame:
    rest = [c for c in grouped.columns if c != window]
    return grouped.select(F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end"), *rest)


def tumbling(df: DataFrame, ts: str, size: str, delay: str, aggs: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    return _flat(df.withWatermark(ts, delay).groupBy(F.window(ts, size), *keys).agg(*aggs), "window")


def sliding(
    df: DataFrame, ts: str, size: str, slide: str, delay: str, aggs: Sequence[Column], keys: Sequence[str] = ()
) -> DataFrame:
    return _flat(df.withWatermark(ts, delay).groupBy(F.window(ts, size, slide), *keys).agg(*aggs), "window")


def sessions(df: DataFrame, ts: str, key: Sequence[str], gap: str, delay: str, aggs: Sequence[Column]) -> DataFrame:
    grouped = df.withWatermark(ts, delay).groupBy(*key, F.session_window(ts, gap)).agg(*aggs)
    return _flat(grouped, "session_window")


def dedup(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per key; a key is remembered for ``delay`` of event time only. All copies of a key meet in one task."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def enrich(df: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Stream with static table. The table is broadcast if it is measured as small."""
    return df.join(broadcast_if_small(dim), key, how)


def interval_join(
    a: DataFrame, b: DataFrame, key: str, a_ts: str, b_ts: str, within_seconds: int, delay: str
) -> DataFrame:
    """Pairs of one key where ``b`` happens at most ``within_seconds`` after ``a``.

    Both sides are also matched on a time bin as long as the interval: ``a`` is put in its
    own bin and the next, ``b`` in its own, so a pair meets once and the rows of a busy key
    are spread over many tasks. The time bound lets old state be dropped.
    """
    bin_of = lambda c: F.floor(F.unix_seconds(c) / within_seconds)
    left = a.withWatermark(a_ts, delay).withColumn("_bin", bin_of(F.col(a_ts)))
    left = left.withColumn("_bin", F.explode(F.array(F.col("_bin"), F.col("_bin") + 1)))
    right = b.withWatermark(b_ts, delay).withColumns({"_bin": bin_of(F.col(b_ts)), "_key": F.col(key)}).drop(key)
    right = right.withColumnRenamed("_bin", "_right_bin")
    bound = F.expr(f"{b_ts} >= {a_ts} AND {b_ts} <= {a_ts} + INTERVAL {within_seconds} SECONDS")
    same = (F.col(key) == F.col("_key")) & (F.col("_bin") == F.col("_right_bin"))
    return left.join(right, same & bound).drop("_key", "_bin", "_right_bin")


def split_bad(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the others with the name of the first broken rule."""
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    marked = df.withColumn("reason", reason)
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def lambda_view(history: DataFrame, recent: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Batch aggregate and stream aggregate put together and aggregated once more."""
    return history.unionByName(recent).groupBy(*keys).agg(*aggs)
