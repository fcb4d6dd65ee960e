"""Mergeable summaries: heavy hitters, distinct counts and quantiles.

A summary is made per task or per partition of a table, has bounded size, and is merged instead of reading the rows again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Entries of a theta sketch (log2) and size parameter of a KLL sketch.
LG_ENTRIES, KLL_K = 14, 400


# --- Heavy hitters --------------------------------------------------------------------------------------------


def _space_saving(batches: Iterator[pa.RecordBatch], entries: int) -> Iterator[pa.RecordBatch]:
    """Hashes that may be frequent among a task's rows, at most ``entries`` of them.

    A batch is counted and added to the summary; if that has too many entries, the count of the first one that has no room is taken off
    all. Counts are too low by at most rows / entries, so a hash with more rows than that is always among the entries.
    """
    held, taken = None, 0
    for batch in batches:
        counts = pc.value_counts(batch.column(0))
        table = pa.table({"h": counts.field(0), "n": counts.field(1)})
        held = table if held is None else pa.concat_tables([held, table]).group_by("h").aggregate([("n", "sum")]).rename_columns(["h", "n"])
        if held.num_rows > entries:
            order = pc.array_sort_indices(held["n"].combine_chunks(), order="descending")
            off = held["n"][order[entries].as_py()].as_py()
            held = held.take(order[:entries])
            held = held.set_column(1, "n", pc.subtract(held["n"], off)).filter(pc.greater(pc.subtract(held["n"], off), 0))
            taken += off
    if held is not None and held.num_rows:
        yield from pa.table({"h": held["h"], "n": pc.add(held["n"], taken)}).combine_chunks().to_batches()


def frequent_keys(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """``keys`` and exact count ``n`` of every key that holds more than ``share`` of all rows: at most 1/share of them.

    Each task summarises its rows in at most 4/share entries, so the first pass shuffles that many rows per task at most and not
    one row per key. A frequent key has more than ``share`` of the rows of some task and is an entry there, so none is overlooked;
    bounds on the sum over tasks thin the candidates out. A second pass counts the candidates alone, exactly, combined before the shuffle.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    entries = math.ceil(4 / share)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _space_saving(batches, entries)

    hashed = df.select(F.xxhash64(*keys).alias("h"))
    total = df.agg(F.count("*")).scalar()
    # An entry's count is its upper bound in that task. Elsewhere the key may have up to a quarter of the share unseen.
    upper = hashed.mapInArrow(summarise, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("upper"))
    maybe = upper.where(F.col("upper") >= total * F.lit(share * 0.74)).select(F.col("h").alias("_h"))
    counted = df.join(maybe, F.xxhash64(*keys) == F.col("_h"), "left_semi").groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > total * F.lit(share))


# --- Distinct counts ------------------------------------------------------------------------------------------


def distinct_sketches(df: DataFrame, by: Sequence[str], column: str, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``by`` and ``sketch``: a theta sketch of the distinct values of ``column`` in each group, to be stored and united later.

    Below 2**lg_entries values the sketch is exact; the standard error of a larger one is about 2 / sqrt(2**lg_entries).
    """
    kind = df.schema[column].dataType
    value = F.col(column) if isinstance(kind, (T.StringType, T.BinaryType, T.LongType, T.IntegerType, T.DoubleType, T.FloatType)) else F.col(column).cast("string")
    return df.groupBy(*by).agg(F.theta_sketch_agg(value, lg_entries).alias("sketch"))


def roll_up(sketches: DataFrame, by: Sequence[str], lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``by``, united ``sketch`` and its estimate ``distinct``, from stored sketches of any finer grouping."""
    united = sketches.groupBy(*by).agg(F.theta_union_agg("sketch", lg_entries).alias("sketch"))
    return united.withColumn("distinct", F.theta_sketch_estimate("sketch"))


def overlap(a: Column, b: Column, lg_entries: int = LG_ENTRIES) -> Column:
    """Estimates (both, only_a, only_b, either) of the distinct values of two sketches."""
    return F.struct(
        F.theta_sketch_estimate(F.theta_intersection(a, b)).alias("both"),
        F.theta_sketch_estimate(F.theta_difference(a, b)).alias("only_a"),
        F.theta_sketch_estimate(F.theta_difference(b, a)).alias("only_b"),
        F.theta_sketch_estimate(F.theta_union(a, b, lg_entries)).alias("either"),
    )


# --- Exact distinct counts ----------------------------------------------------------------------------------------

#: Columns of a stored set: the range of values it covers and one bit per value of that range.
BUCKET, BITS = "bucket", "bits"


def distinct_bitmaps(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """``by``, ``bucket`` and ``bits``: the distinct values of ``column`` in each group as bits, to be stored and united later without any error.

    ``column`` holds whole numbers. A bucket covers 32,768 neighbouring numbers in 4 KB and exists only if one of them occurs, so this is
    for keys that are numbered more or less in a row; of keys far apart each takes a bucket of its own. Nulls have an empty bucket, which
    keeps groups without a value.
    """
    if not isinstance(df.schema[column].dataType, T.IntegralType):
        raise ValueError(f"{column} does not hold whole numbers")
    value = F.col(column).cast("long")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias(BITS)
    return df.groupBy(*by, F.bitmap_bucket_number(value).alias(BUCKET)).agg(bits)


def count_bits(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by`` and the exact number ``distinct`` of values in stored bitmaps of any finer grouping."""
    united = bitmaps.groupBy(*by, BUCKET).agg(F.bitmap_count(F.bitmap_or_agg(BITS)).alias("n"))
    return united.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("distinct"))


def overlap_bits(bitmaps: DataFrame, a: Column, b: Column) -> DataFrame:
    """One row of exact counts (both, only_a, only_b, either) of the values in the bitmaps where ``a`` holds and in those where ``b`` holds."""
    size = lambda where: F.bitmap_count(F.bitmap_or_agg(F.when(where, F.col(BITS))))
    united = bitmaps.groupBy(BUCKET).agg(size(a).alias("a"), size(b).alias("b"), size(a | b).alias("either"))
    n_a, n_b, either = (F.coalesce(F.sum(c), F.lit(0)) for c in ("a", "b", "either"))
    return united.agg((n_a + n_b - either).alias("both"), (either - n_b).alias("only_a"), (either - n_a).alias("only_b"), either.alias("either"))


# --- Quantiles ------------------------------------------------------------------------------------------------


def quantile_sketches(df: DataFrame, by: Sequence[str], column: str, k: int = KLL_K) -> DataFrame:
    """``by``, ``rows`` (values that are not null), ``low``, ``high`` and a KLL ``sketch`` of ``column`` per group.

    Stored per partition or file of a table, a new partition costs its own rows only. The rank error is about 1.7 / k of the rows.
    """
    value = F.col(column).cast("double")
    return df.groupBy(*by).agg(
        F.count(value).alias("rows"), F.min(value).alias("low"), F.max(value).alias("high"), F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch")
    )


def merge_quantiles(sketches: DataFrame, by: Sequence[str], k: int = KLL_K) -> DataFrame:
    """Stored quantile sketches of any finer grouping merged to ``by``."""
    full = sketches.where("rows > 0")
    return full.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch")
    )


def quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The columns of ``sketches`` but the sketch itself, and ``quantiles``: the value at each of the given shares of the rows."""
    at = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(s)) for s in shares]))
    return sketches.withColumn("quantiles", at).drop("sketch")


def histogram(sketches: DataFrame, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``bin`` (from 0), ``lo``, ``hi`` and estimated ``rows`` of an equal-height histogram, one row per bin."""
    shares = [i / bins for i in range(1, bins)]
    if not shares:
        return sketches.select(*by, F.lit(0).alias("bin"), F.col("low").alias("lo"), F.col("high").alias("hi"), F.col("rows").cast("double").alias("rows"))
    inner = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(s) for s in shares]))
    edges = sketches.select(*by, "rows", F.concat(F.array("low"), inner, F.array("high")).alias("edges"))
    each = edges.select(*by, "rows", "edges", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return each.select(
        *by, "bin", F.get("edges", F.col("bin")).alias("lo"), F.get("edges", F.col("bin") + 1).alias("hi"), (F.col("rows") / bins).alias("rows")
    )
