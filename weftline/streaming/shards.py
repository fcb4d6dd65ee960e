"""Keyed state in shards: many keys share one state, so that calls of Python and trips to the state store are paid per shard."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, GroupedData, functions as F
from pyspark.sql.types import DataType

#: Without an underscore in front, which Spark's pandas rows of a state operator would lose.
HELD, SHARD = "held_key", "held_shard"
#: Fixed, because a checkpoint outlives a change of the cluster. A state holds the keys of one shard and is read whole.
SHARDS = 512
#: Rows that a fold takes at least at once, and entries after which it hands on what it holds.
CHUNK, FLUSH = 50_000, 200_000

Fold = Callable[[pd.DataFrame | None, pd.DataFrame], pd.DataFrame]


def held_as_text(df: DataFrame, key: str) -> DataFrame:
    """The key as text that is never null: pandas would turn whole numbers beside a null into floats, and a state key of nulls into zero."""
    return df.withColumn(HELD, F.coalesce(F.concat(F.lit("."), F.col(key).cast("string")), F.lit("")))


def from_text(df: DataFrame, key: str, kind: DataType) -> DataFrame:
    plain = F.when(F.col(HELD) != "", F.col(HELD).substr(F.lit(2), F.length(HELD))).cast(kind)
    return df.select(plain.alias(key), *[c for c in df.columns if c != HELD])


def by_shard(df: DataFrame) -> GroupedData:
    return df.withColumn(SHARD, F.pmod(F.xxhash64(HELD), F.lit(SHARDS)).cast("int")).groupBy(SHARD)


def folded(batches: Iterator[pd.DataFrame], add: Fold) -> Iterator[pd.DataFrame]:
    """What ``add`` makes of a task's rows, in bounded pieces.

    It is called once as many rows wait as it holds entries, so entries are not gone through again for every small batch.
    """
    held, waiting, n = None, [], 0
    for batch in batches:
        waiting.append(batch)
        n += len(batch)
        if n >= max(CHUNK, 0 if held is None else len(held)):
            held, waiting, n = add(held, pd.concat(waiting, ignore_index=True)), [], 0
            if len(held) > FLUSH:
                yield held
                held = None
    if waiting:
        held = add(held, pd.concat(waiting, ignore_index=True))
    if held is not None:
        yield held


def micros(times: pd.Series) -> list[int]:
    """Microseconds since 1970; a missing time is far below zero."""
    return times.astype("datetime64[us]").astype("int64").tolist()


def due(newest_ms: int, watermark: int, idle_ms: int) -> int:
    """When a key that has rows now is to be closed: after the watermark, so a late key is closed with the next batch.

    A key without any time waits as long as one that was just seen. It has no due time (0) as long as there is no watermark either.
    """
    since = newest_ms or watermark
    return max(since + idle_ms, watermark + 1) if since else 0


def next_timer(dues: list[int], watermark: int) -> int:
    """The earliest time at which a shard has something to do."""
    return max(min(dues), watermark + 1)
