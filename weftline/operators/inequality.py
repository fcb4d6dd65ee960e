"""Join of two large sides on two inequalities, such as the overlap of intervals.

Both sides are cut along the column of the first inequality into blocks of bounded size, whatever the values are. Smallest
and largest values of a block tell which pairs of blocks can hold a result; only those meet, each in a task of its own. Inside a
pair one side is walked along the first inequality while the other one's rows are marked, one after the other, in a bit array
whose places follow the second inequality; what is marked beyond a row's own place is its result. So no row is
compared with a row that it doesn't meet, but for the scan of bits, and no nested loop or tile of all pairs is needed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from weftline.operators.windows import micros
from weftline.session import materialise

#: Rows of a block, and of a batch of results.
BLOCK_ROWS, BATCH_ROWS = 50_000, 100_000
FLIPPED = {"<": ">", "<=": ">=", ">": "<", ">=": "<="}


def inequality_join(
    left: DataFrame,
    right: DataFrame,
    first: tuple[str, str, str],
    second: tuple[str, str, str],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Inner join on ``left.a op right.b`` for both conditions (a, op, b) with op one of <, <=, >, >=.

    The columns must be numbers, dates or timestamps; rows with a null or NaN in one of them have no partner. All columns of both sides
    are returned and their names must differ. Results of a pair of blocks are handed on in batches.
    """
    if set(left.columns) & set(right.columns):
        raise ValueError(f"columns on both sides: {sorted(set(left.columns) & set(right.columns))}")
    for a, op, b in (first, second):
        if op not in FLIPPED:
            raise ValueError(f"not an inequality: {op}")
    sides = _blocks(left, first[0], second[0], block_rows), _blocks(right, first[2], second[2], block_rows)
    pairs = _candidates(*(side.groupBy("_block").agg(*_bounds()) for side in sides), first[1], second[1])
    out = T.StructType([*left.schema, *right.schema])
    # Both sides go through one shuffle, as rows of which one half is null.
    halves = []
    for side, own, name, mark in zip(sides, (left, right), ("_a", "_b"), (0, 1)):
        dealt = side.join(pairs, F.col("_block") == F.col(name))
        halves.append(dealt.select("_pair", F.lit(mark).alias("_side"), "_x", "_z", F.struct(*own.columns).alias(f"_row{mark}")))
    both = halves[0].unionByName(halves[1], allowMissingColumns=True)
    return both.groupBy("_pair").applyInArrow(_meeting(first[1], second[1]), out)


def _number(df: DataFrame, column: str):
    """An order-preserving number: microseconds or the value itself."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return micros(df, column)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(column).cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    raise ValueError(f"{column} is neither a number nor a time: {kind.simpleString()}")


def _blocks(df: DataFrame, x: str, z: str, block_rows: int) -> DataFrame:
    """Rows with their two numbers and block. Equal values are cut by the other number and then by a hash of the row."""
    numbered = df.withColumns({"_x": _number(df, x), "_z": _number(df, z)}).where("_x IS NOT NULL AND _z IS NOT NULL")
    parts = max(1, math.ceil(numbered.count() / block_rows))
    dealt = numbered.repartitionByRange(parts, "_x", "_z", F.xxhash64(*df.columns))
    # The bounds of ranges come from a sample, so the block is written down.
    return materialise(dealt.withColumn("_block", F.spark_partition_id()), "blocks")


def _bounds():
    return [F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_z").alias("z0"), F.max("_z").alias("z1")]


def _candidates(left: DataFrame, right: DataFrame, first: str, second: str) -> DataFrame:
    """(_a, _b, _pair) of the blocks that can hold a result, found from one row per block."""

    def may(op: str, column: str):
        low, high = f"{column}0", f"{column}1"
        a, b = (F.col(f"l.{low}"), F.col(f"r.{high}")) if op in ("<", "<=") else (F.col(f"l.{high}"), F.col(f"r.{low}"))
        return {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[op]

    met = left.alias("l").join(F.broadcast(right.alias("r")), may(first, "x") & may(second, "z"))
    named = met.select(F.col("l._block").alias("_a"), F.col("r._block").alias("_b"))
    return materialise(named.withColumn("_pair", F.monotonically_increasing_id()), "block-pairs")


def _meeting(first: str, second: str):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()  # two blocks
        mark = table["_side"].to_numpy()
        a, b = (table.filter(pa.array(mark == k)) for k in (0, 1))
        rows_a, rows_b = (t[f"_row{k}"].combine_chunks() for k, t in enumerate((a, b)))
        for i, j in _met(*(t[c].to_numpy() for t in (a, b) for c in ("_x", "_z")), first, second):
            columns = rows_a.take(pa.array(i)).flatten() + rows_b.take(pa.array(j)).flatten()
            names = [f.name for r in (rows_a, rows_b) for f in r.type]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return meet


def _met(ax, az, bx, bz, first: str, second: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with ``ax[i] first bx[j]`` and ``az[i] second bz[j]``, in batches."""
    if not len(ax) or not len(bx):
        return
    if first in (">", ">="):
        ax, bx = -ax, -bx
        first = FLIPPED[first]
    if second in ("<", "<="):
        az, bz = -az, -bz
        second = FLIPPED[second]
    # Now ax < bx and az > bz, or with equality. The permutation gives each row of A its place by z.
    by_z = np.argsort(az, kind="stable")
    place = np.empty(len(az), np.int64)
    place[by_z] = np.arange(len(az))
    by_x, walk = np.argsort(ax, kind="stable"), np.argsort(bx, kind="stable")
    upto = np.searchsorted(ax[by_x], bx[walk], "left" if first == "<" else "right")
    start = np.searchsorted(az[by_z], bz[walk], "right" if second == ">" else "left")
    marked, done, found, size = np.zeros(len(az), bool), 0, [], 0
    for j, stop, low in zip(walk.tolist(), upto.tolist(), start.tolist()):
        if stop > done:
            marked[place[by_x[done:stop]]] = True
            done = stop
        if not done or low == len(marked):
            continue
        hits = np.flatnonzero(marked[low:])
        if len(hits):
            found.append((by_z[hits + low], np.full(len(hits), j)))
            size += len(hits)
        if size >= BATCH_ROWS:
            yield tuple(map(np.concatenate, zip(*found)))
            found, size = [], 0
    if found:
        yield tuple(map(np.concatenate, zip(*found)))
