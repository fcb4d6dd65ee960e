"""Custom state per key: running totals that expire."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from weftline.streaming.shards import HELD, by_shard, due, folded, from_text, held_as_text, micros, next_timer


def _combine(df: DataFrame, amount: str, ts: str) -> DataFrame:
    """One row per key and task before the shuffle, so that a busy key sends little."""
    schema = StructType(
        [
            StructField(HELD, StringType()),
            StructField("n", LongType()),
            StructField("amount", LongType()),
            StructField("last_ts", TimestampType()),
        ]
    )

    def add(held: pd.DataFrame | None, batch: pd.DataFrame) -> pd.DataFrame:
        rows = batch.assign(n=1)
        rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
        return rows.groupby(HELD, as_index=False).agg({"n": "sum", "amount": "sum", "last_ts": "max"})

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from folded(batches, add)

    value = F.coalesce(F.col(amount).cast("long"), F.lit(0)).alias("amount")
    return df.select(HELD, value, F.col(ts).alias("last_ts")).mapInPandas(fold, schema)


def _running(idle_ms: int):
    """Update of a shard of keys. Per key it holds count, sum, newest time and when the key is to be closed."""

    def update(_group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        held = {key: list(values) for key, *values in zip(*state.get)} if state.exists else {}
        for values in held.values():
            values[3] = values[3] or due(values[2], watermark, idle_ms)
        # A key whose time is up is closed first, and its new rows start again.
        over = [key for key, values in held.items() if values[3] and values[3] <= watermark]
        out = [(key, *held.pop(key)[:2], True) for key in over]
        met: dict[str, list[int]] = {}
        for pdf in batches:
            for key, n, amount, at in zip(pdf[HELD].tolist(), pdf["n"].tolist(), pdf["amount"].tolist(), micros(pdf["last_ts"])):
                values = met[key] = held.setdefault(key, [0, 0, 0, 0])
                values[0], values[1], values[2] = values[0] + n, values[1] + amount, max(values[2], at // 1000)
        for values in met.values():
            values[3] = due(values[2], watermark, idle_ms)
        if held:
            state.update((list(held), *map(list, zip(*held.values()))))
            state.setTimeoutTimestamp(next_timer([values[3] for values in held.values()], watermark))
        elif state.exists:
            state.remove()
        out += [(key, *values[:2], False) for key, values in met.items()]
        yield pd.DataFrame(out, columns=[HELD, "n", "amount", "closed"])

    return update


def keyed_state(df: DataFrame, key: str, amount: str, ts: str, delay: str, idle_seconds: int) -> DataFrame:
    """Running count and sum per key: one row per key and micro-batch, and a closing row when
    the key was silent for ``idle_seconds`` of event time, after which it is forgotten.

    Keys lie in the state of their shard. Null amounts count as nothing; ``key`` is of a type that can be cast to text and back."""
    combined = _combine(held_as_text(df, key), amount, ts).withWatermark("last_ts", delay)
    rows = by_shard(combined).applyInPandasWithState(
        _running(idle_seconds * 1000),
        outputStructType=f"{HELD} string, n long, amount long, closed boolean",
        stateStructType="keys array<string>, n array<long>, amount array<long>, newest array<long>, due array<long>",
        outputMode="update",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )
    return from_text(rows, key, df.schema[key].dataType)
