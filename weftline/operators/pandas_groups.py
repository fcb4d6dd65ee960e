"""Pandas operators: vectorised scalars, custom aggregates, grouped and partition-wise functions."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from weftline.operators.joins import fits
from weftline.operators.skew import SALT, hot_and_total, hot_rows, in_groups, salts_for, spread_hot

Frames = Iterator[pd.DataFrame]
GROUP_ROWS = 1_000_000


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, name: str) -> DataFrame:
    """Value of a dimension per row, from a dictionary sent once to each executor, or by a join if it is large.

    A broadcast join does the same without Python; use this inside other Python work.
    """
    if not fits(dim):
        values = dim.select(F.col(dim_key).alias("_key"), F.col(value).alias(name))
        return df.join(values, F.col(key) == F.col("_key"), "left").drop("_key")
    table = {row[0]: row[1] for row in dim.select(dim_key, value).collect()}
    shared = df.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf(dim.schema[value].dataType)
    def find(keys: pd.Series) -> pd.Series:
        return keys.map(shared.value)

    return df.withColumn(name, find(key))


def vectorised(fn: Callable[..., pd.Series], returns: T.DataType | str, *columns: str) -> Column:
    """A function of whole column batches."""

    # The number of arguments is part of the type hints that select the kind of function.
    if len(columns) == 1:

        def one(a: pd.Series) -> pd.Series:
            return fn(a)

        return F.pandas_udf(one, returns)(*columns)

    def many(*series: pd.Series) -> pd.Series:
        return fn(*series)

    return F.pandas_udf(many, returns)(*columns)


def per_group(
    df: DataFrame,
    keys: Sequence[str],
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    merge: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
    spread_by: Sequence[str] | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Apply ``fn`` to the rows of each group as one pandas frame.

    With ``merge``, groups above the row limit are cut into pieces; ``fn`` then sees a piece, and ``merge`` turns
    the results of a group's pieces into one. Without it ``fn`` sees every group whole, whatever its size, and the
    group has to fit in the memory of a Python worker; ``stream_groups`` has no such limit.
    """
    limit = max_rows or min(GROUP_ROWS, hot_rows(df.sparkSession))
    if merge is None:
        return _by_key(df, keys).groupBy(*keys).applyInPandas(fn, schema)
    hot, total = hot_and_total(df, keys, limit)
    parts = max(min(df.sparkSession.sparkContext.defaultParallelism, total), math.ceil(total / limit), 1)
    if not hot:
        return _by_key(df, keys, parts).groupBy(*keys).applyInPandas(fn, schema)
    # Twice the pieces, because a hash fills them unevenly.
    cut = spread_hot(df, in_groups(keys, list(hot)), spread_by or df.columns, 2 * salts_for(hot, limit))
    partial = _by_key(cut, [*keys, SALT], parts).groupBy(*keys, SALT).applyInPandas(lambda pdf: fn(pdf.drop(columns=SALT)), schema)
    return partial.groupBy(*keys).applyInPandas(merge, schema)


def stream_groups(df: DataFrame, keys: Sequence[str], fn: Callable[[tuple, Frames], Frames], schema: str, order: Sequence[str] = ()) -> DataFrame:
    """Apply ``fn`` to the key and the rows of each group as a stream of pandas frames, one Arrow batch at a time.

    A worker holds one batch and what ``fn`` keeps, so a group may be larger than its memory and needs no ``merge``. With ``order``
    the rows come sorted by those columns (ascending, nulls first); Spark's sort spills to disk. A group is one task.
    """
    by = list(keys)
    dealt = _by_key(df, by)
    if not order:

        def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield from fn(key, batches)

        return dealt.groupBy(*by).applyInPandas(run, schema)
    return dealt.sortWithinPartitions(*by, *order).mapInPandas(_split_by(by, fn), schema)


def _split_by(by: list[str], fn: Callable[[tuple, Frames], Frames]) -> Callable[[Frames], Frames]:
    """Cut a stream of frames sorted by key into one stream per group."""

    def run(batches: Frames) -> Frames:
        ahead: list[tuple[tuple, pd.DataFrame]] = []

        def parts() -> Iterator[tuple[tuple, pd.DataFrame]]:
            for pdf in batches:
                if len(pdf):
                    known = pdf[by].apply(lambda c: c.astype(object).where(c.notna(), None))
                    starts = (known != known.shift()).any(axis=1) & ~(known.isna() & known.shift().isna()).all(axis=1)
                    starts.iloc[0] = True
                    at = [*starts.to_numpy().nonzero()[0].tolist(), len(pdf)]
                    for i, j in zip(at, at[1:]):
                        yield tuple(known.iloc[i]), pdf.iloc[i:j].reset_index(drop=True)

        pieces = parts()

        def group(key: tuple) -> Frames:
            while ahead and ahead[0][0] == key:
                yield ahead.pop()[1]
                ahead.extend(islice(pieces, 1))

        ahead.extend(islice(pieces, 1))
        while ahead:
            key = ahead[0][0]
            rest = group(key)
            yield from fn(key, rest)
            for _ in rest:  # what the function did not read
                pass

    return run


def _by_key(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Shuffle by key. Python work is not measured in bytes, so the number of partitions is stated and not lowered at run time."""
    return df.repartition(parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def combine_by_key(
    df: DataFrame,
    keys: Sequence[str],
    schema: str,
    partial: Callable[[pd.DataFrame], pd.DataFrame],
    merge: Callable[[pd.DataFrame], pd.DataFrame],
    max_states: int = 200_000,
) -> DataFrame:
    """Custom aggregate with a combine step before the shuffle.

    Every task folds its rows into one state per key and sends only states on, so a
    hot key reaches its final task as one row per input partition. ``partial`` and
    ``merge`` both take a frame of several keys and return one row per key.
    """

    def fold(batches: Frames) -> Frames:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            held.append(partial(batch))
            size += len(held[-1])
            if len(held) > 32 or size > max_states:
                held = [merge(pd.concat(held, ignore_index=True))]
                size = len(held[0])
                if size > max_states:
                    yield held.pop()
                    size = 0
        if held:
            yield merge(pd.concat(held, ignore_index=True))

    def finish(batches: Frames) -> Frames:
        # Sorted by key, so only the last key of a batch can go on in the next one.
        open_states = None
        for batch in batches:
            states = batch if open_states is None else pd.concat([open_states, batch], ignore_index=True)
            merged = merge(states)
            going_on = _same_key(merged, states[by].iloc[-1])
            open_states = merged[going_on]
            yield merged[~going_on]
        if open_states is not None:
            yield open_states

    by = list(keys)
    states = df.mapInPandas(fold, schema)
    return _by_key(states, by).sortWithinPartitions(*by).mapInPandas(finish, schema)


def _same_key(pdf: pd.DataFrame, key: pd.Series) -> pd.Series:
    same = pd.Series(True, index=pdf.index)
    for name, value in key.items():
        same &= pdf[name].isna() if pd.isna(value) else pdf[name] == value
    return same


def second_largest(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The largest and second largest distinct value per group, as a custom aggregate."""
    by = list(keys)

    def top_two(long: pd.DataFrame) -> pd.DataFrame:
        distinct = long.dropna(subset=["value"]).drop_duplicates().sort_values("value", ascending=False)
        ranked = distinct.assign(place=distinct.groupby(by, dropna=False).cumcount())
        first = ranked[ranked.place == 0].set_index(by)["value"].rename("largest")
        second = ranked[ranked.place == 1].set_index(by)["value"].rename("second")
        return pd.concat([first, second], axis=1).reset_index()

    def partial(batch: pd.DataFrame) -> pd.DataFrame:
        return top_two(batch.rename(columns={column: "value"})[[*by, "value"]])

    def merge(states: pd.DataFrame) -> pd.DataFrame:
        both = [states[[*by, c]].rename(columns={c: "value"}) for c in ("largest", "second")]
        return top_two(pd.concat(both, ignore_index=True))

    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in by)
    return combine_by_key(df.select(*by, column), by, f"{kinds}, largest double, second double", partial, merge)
