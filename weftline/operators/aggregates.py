"""Aggregations beyond a plain ``groupBy``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weftline.operators.windows import _attach, running
from weftline.session import materialise


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Several groupings in one pass; ``grouping_id`` tells them apart from real nulls."""
    columns = [[F.col(c) for c in one] for one in sets]
    return df.groupingSets(columns, *[F.col(k) for k in keys]).agg(F.grouping_id().cast("int").alias("grouping_id"), *aggs)


def exact_percentiles(df: DataFrame, keys: Sequence[str], column: str, at: dict[str, float]) -> DataFrame:
    """Interpolated percentiles of ``column`` per group, exact for groups of any size.

    Values are first counted, which is combined before the shuffle. The position of
    each distinct value then comes from a running total that cuts hot groups, so no
    task ever holds the values of a whole group.
    """
    every = materialise(df.groupBy(*keys, column).agg(F.count("*").alias("_n")), "value-counts")
    counts = every.where(F.col(column).isNotNull())
    placed = running(counts, keys, [column], F.col("_n"), "_upto")
    placed = _attach(placed, counts.groupBy(*keys).agg(F.sum("_n").alias("_total")), keys)
    ends, results = [], []
    for name, p in at.items():
        position = F.lit(p) * (F.col("_total") - 1)
        for side, index in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            ends.append(F.min(F.when(F.col("_upto") > index, F.col(column))).alias(f"_{name}_{side}"))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        results.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    found = placed.groupBy(*keys, "_total").agg(*ends).select(*keys, *results)
    # A group that holds nulls only has null percentiles.
    return _attach(every.select(*keys).distinct(), found, keys)


def pivot_sum(df: DataFrame, rows: Sequence[Column | str], column: str, values: Sequence[str], agg: Column) -> DataFrame:
    """Pivot over known values: no extra job to find them, and a fixed schema."""
    return df.groupBy(*rows).pivot(column, list(values)).agg(agg)


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)
