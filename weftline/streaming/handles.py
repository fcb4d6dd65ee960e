"""State of several kinds per key, with timers: totals in a value, the last events in a list, counts per kind in a map."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from weftline.streaming.shards import HELD, by_shard, due, folded, from_text, held_as_text, micros, next_timer


def _combine(df: DataFrame, kind: str, amount: str, ts: str, row_id: str, last: int) -> DataFrame:
    """What a task has of each key, before the shuffle: one counting row per kind, and its ``last`` newest events.

    Newest events count nothing (``n`` is 0). Nulls are told apart before pandas, which would turn whole numbers beside them into floats.
    """
    schema = StructType(
        [
            StructField(HELD, StringType()),
            StructField("kind", StringType()),
            StructField("n", LongType()),
            StructField("amount", LongType()),
            StructField("at", TimestampType()),
            StructField("row_id", LongType()),
        ]
    )

    def add(held: pd.DataFrame | None, batch: pd.DataFrame) -> pd.DataFrame:
        seen = batch.drop(columns="named").assign(n=1, row_id=0)
        named = batch[batch["named"]].drop(columns="named").assign(kind=None, n=0, amount=0)
        if held is not None:
            seen, named = (pd.concat([old, new], ignore_index=True) for old, new in ((held[held["n"] > 0], seen), (held[held["n"] == 0], named)))
        counts = seen.groupby([HELD, "kind"], as_index=False, dropna=False).agg({"n": "sum", "amount": "sum", "at": "max", "row_id": "max"})
        newest = named.sort_values(["at", "row_id"]).groupby(HELD).tail(last)
        return pd.concat([counts, newest], ignore_index=True)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held in folded(batches, add):
            yield held[schema.fieldNames()]

    plain = df.select(
        HELD, F.col(kind).cast("string").alias("kind"), F.coalesce(F.col(amount).cast("long"), F.lit(0)).alias("amount"), F.col(ts).alias("at"),
        F.coalesce(F.col(row_id).cast("long"), F.lit(0)).alias("row_id"), (F.col(ts).isNotNull() & F.col(row_id).isNotNull()).alias("named"),
    )
    return plain.mapInPandas(fold, schema)


@dataclass(slots=True)
class _Seen:
    """What is held of one key while its shard is at work."""

    n: int = 0
    amount: int = 0
    newest: int = 0
    turn: int = 0
    due: int = 0
    events: list[tuple[int, int]] = field(default_factory=list)
    kinds: dict[str, int] = field(default_factory=dict)


class _Activity(StatefulProcessor):
    """Emits a row per key and micro-batch, and a closing row when a key's time is up. Its state is that of a shard of keys.

    A value holds the totals, column by column; a list holds the newest event of each key, then the one before, and so on; a map holds the counts
    of each kind. A shard's timer is the earliest of its keys.
    """

    def __init__(self, last: int, idle_ms: int):
        self.last, self.idle_ms = last, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        longs = ", ".join(f"{name} array<long>" for name in ("n", "amount", "newest", "turn", "due"))
        self.totals = handle.getValueState("totals", f"keys array<string>, {longs}")
        self.events = handle.getListState("events", "keys array<string>, at array<long>, row_id array<long>")
        self.kinds = handle.getMapState("kinds", "kind string", "keys array<string>, n array<long>")

    def _load(self, watermark: int) -> dict[str, _Seen]:
        held = {key: _Seen(*totals) for key, *totals in zip(*self.totals.get())} if self.totals.exists() else {}
        for keys, at, row_id in self.events.get() if self.events.exists() else ():
            for key, event in zip(keys, zip(at, row_id)):
                held[key].events.append(event)
        for (kind,), (keys, counts) in self.kinds.iterator() if self.kinds.exists() else ():
            for key, n in zip(keys, counts):
                held[key].kinds[kind] = n
        for seen in held.values():
            seen.due = seen.due or due(seen.newest, watermark, self.idle_ms)
        return held

    def _close(self, held: dict[str, _Seen], watermark: int) -> tuple[list[tuple], set[str]]:
        """Rows of the keys whose time is up, and the kinds they had; the keys are forgotten."""
        over = [key for key, seen in held.items() if seen.due and seen.due <= watermark]
        kinds = {kind for key in over for kind in held[key].kinds}
        return [self._row(key, held.pop(key), True) for key in over], kinds

    def _save(self, held: dict[str, _Seen], kinds: set[str], watermark: int) -> None:
        """Write the state and the timer; of the map, only the given kinds."""
        timers = list(self.handle.listTimers())
        at = next_timer([seen.due for seen in held.values()], watermark) if held else None
        for timer in timers:
            if timer != at and timer > watermark:
                self.handle.deleteTimer(timer)
        if not held:
            self.totals.clear()
            self.events.clear()
            self.kinds.clear()
            return
        if at not in timers:
            self.handle.registerTimer(at)
        self.totals.update((list(held), *map(list, zip(*((s.n, s.amount, s.newest, s.turn, s.due) for s in held.values())))))
        ranked = [[(key, *seen.events[i]) for key, seen in held.items() if len(seen.events) > i] for i in range(self.last)]
        ranked = [tuple(map(list, zip(*rank))) for rank in ranked if rank]
        self.events.put(ranked) if ranked else self.events.clear()
        counts: dict[str, list[tuple[str, int]]] = {kind: [] for kind in kinds}
        for key, seen in held.items():
            for kind in seen.kinds.keys() & kinds:
                counts[kind].append((key, seen.kinds[kind]))
        for kind, pairs in counts.items():
            self.kinds.updateValue((kind,), tuple(map(list, zip(*pairs)))) if pairs else self.kinds.removeKey((kind,))

    @staticmethod
    def _row(key: str, seen: _Seen, closed: bool) -> tuple:
        last = ",".join(str(row_id) for _, row_id in reversed(seen.events))
        return key, seen.n, seen.amount, last, ",".join(f"{kind}={n}" for kind, n in sorted(seen.kinds.items())), closed, seen.turn

    @staticmethod
    def _frame(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=[HELD, "n", "amount", "last_events", "kinds", "closed", "turn"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        # Rows are handled before timers: a key whose time is up is closed first, and its new rows start again.
        watermark = timerValues.getCurrentWatermarkInMs()
        held = self._load(watermark)
        out, kinds = self._close(held, watermark)
        met: dict[str, _Seen] = {}
        for pdf in rows:
            columns = [pdf[c].tolist() for c in (HELD, "kind", "n", "amount", "row_id")]
            for name, kind, n, amount, row_id, at in zip(*columns, micros(pdf["at"])):
                seen = met.get(name)
                if seen is None:
                    seen = met[name] = held.setdefault(name, _Seen())
                if not n:
                    seen.events.append((at, row_id))
                    continue
                seen.n, seen.amount, seen.newest = seen.n + n, seen.amount + amount, max(seen.newest, at // 1000)
                if isinstance(kind, str):
                    seen.kinds[kind] = seen.kinds.get(kind, 0) + n
                    kinds.add(kind)
        for seen in met.values():
            seen.events = sorted(seen.events, reverse=True)[: self.last]
            seen.turn, seen.due = seen.turn + 1, due(seen.newest, watermark, self.idle_ms)
        self._save(held, kinds, watermark)
        out += [self._row(name, seen, False) for name, seen in met.items()]
        if out:
            yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        watermark = timerValues.getCurrentWatermarkInMs()
        held = self._load(watermark)
        out, kinds = self._close(held, watermark)
        self._save(held, kinds, watermark)
        if out:
            yield self._frame(out)

    def close(self) -> None:
        pass


def activity(
    df: DataFrame, key: str, kind: str, amount: str, ts: str, row_id: str, delay: str, last: int, idle_seconds: int
) -> DataFrame:
    """Per key the count, the sum, the ids of the ``last`` newest rows (oldest first) and the count per kind.

    One row per key and micro-batch (``turn`` numbers them), and a closing row when the key was silent for ``idle_seconds`` of event time, after which all its
    state is forgotten. State per key is bounded by ``last`` and by the number of kinds; it lies in the state of the key's shard, which is read and
    written once per micro-batch. Null amounts count as nothing in the sum; rows without a kind are in no kind; rows without time or id are
    counted but never among the newest. ``row_id`` is a whole number, ``key`` of a type that can be cast to text and back.
    """
    combined = _combine(held_as_text(df, key), kind, amount, ts, row_id, last).withWatermark("at", delay)
    rows = by_shard(combined).transformWithStateInPandas(
        _Activity(last, idle_seconds * 1000),
        outputStructType=f"{HELD} string, n long, amount long, last_events string, kinds string, closed boolean, turn long",
        outputMode="update",
        timeMode="eventTime",
    )
    return from_text(rows, key, df.schema[key].dataType)
