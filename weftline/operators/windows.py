"""Window functions that do not put one huge group into one task.

Each function first looks for groups above the row limit (one count per key).
Without any, the plan is the plain window and a single shuffle. Hot groups are
range-partitioned on all their order columns, which gives slices of similar size whatever the
values are, and written with their slice number, so that every later use sees the same slices. The
window runs inside each slice and a table with one row per slice supplies what came before it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.window import WindowSpec

from weftline.operators.skew import hot_counts, hot_rows, in_groups
from weftline.session import materialise

SLICE = "_slice"
RN = "_rn"
FINER = 2  # slices per row limit: range bounds come from a sample, so slices differ in size


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since the epoch, independent of the session time zone for zoneless values."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long") * 86_400_000_000
    seconds = F.extract(F.lit("SECOND"), c)
    whole = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400
    whole = whole + F.hour(c) * 3_600 + F.minute(c) * 60
    return whole * 1_000_000 + (seconds * 1_000_000).cast("long")


def _directed(order: Sequence[str], desc: bool) -> list[Column]:
    return [F.col(c).desc() if desc else F.col(c).asc() for c in order]


@dataclass(frozen=True)
class _Cut:
    """Rows with their slice number: -1 in normal groups, rising along the order in hot ones."""

    rows: DataFrame

    def per_slice(self, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
        named = [agg.alias(name) for name, agg in aggs.items()]
        return self.rows.where(F.col(SLICE) >= 0).groupBy(*keys, SLICE).agg(*named)

    def sums_before(self, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
        """Per slice the sum of each aggregate over the earlier slices of its group."""
        earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        sums = [F.sum(name).over(earlier).alias(name) for name in aggs]
        return self.per_slice(keys, aggs).select(*keys, SLICE, *sums)

    def attach(self, df: DataFrame, summary: DataFrame, on: Sequence[str]) -> DataFrame:
        """Join back a summary with at most one row per slice, written first: Spark broadcasts it if its files are small."""
        return _attach(df, materialise(summary, "slices"), on)


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[Column], max_rows: int | None) -> _Cut | None:
    """Cut the hot groups along ``order``; rows that are equal in all of it share a slice. None without hot groups."""
    hot = hot_counts(df, keys, max_rows)
    if not hot:
        return None
    limit = hot_rows(df.sparkSession, max_rows)
    is_hot, slices = in_groups(keys, list(hot)), math.ceil(sum(hot.values()) / limit) * FINER + 1
    # Range bounds are sampled anew by every execution, so the slice numbers are written down once.
    dealt = df.where(is_hot).repartitionByRange(slices, *keys, *order)
    sliced = materialise(dealt.withColumn(SLICE, F.spark_partition_id().cast("long")), "hot-groups")
    return _Cut(df.where(~is_hot).withColumn(SLICE, F.lit(-1).cast("long")).unionByName(sliced))


def _attach(df: DataFrame, summary: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on columns that may be null; the summary's values get the column names they have."""
    renamed = summary.withColumnsRenamed({c: f"_s_{c}" for c in on})
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in on])
    return df.join(renamed, same, "left").drop(*[f"_s_{c}" for c in on])


def _numbered(cut: _Cut, keys: Sequence[str], order: Sequence[Column | str], name: str) -> DataFrame:
    """The rows of a cut with their number in the whole group."""
    local = cut.rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys, SLICE).orderBy(*order)).cast("long"))
    joined = cut.attach(local, cut.sums_before(keys, {"_before": F.count("*")}), [*keys, SLICE])
    return joined.withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0))).drop("_before")


def _value_ranks(values: DataFrame, part: Sequence[str], order: Sequence[Column], max_rows: int | None) -> DataFrame:
    """Distinct order values with ``_n`` rows each: the rows and the values that come before each of them in its group."""
    earlier = lambda *by: Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counts = lambda *by: {
        "_rows": F.coalesce(F.sum("_n").over(earlier(*by)), F.lit(0)),
        "_values": F.coalesce(F.count("*").over(earlier(*by)), F.lit(0)),
    }
    cut = _cut(values, part, order, max_rows)
    if cut is None:
        return values.withColumns(counts(*part))
    before = cut.sums_before(part, {"_rows_before": F.sum("_n"), "_values_before": F.count("*")})
    joined = cut.attach(cut.rows.withColumns(counts(*part, SLICE)), before, [*part, SLICE])
    whole = {c: F.col(c) + F.coalesce(f"{c}_before", F.lit(0)) for c in ("_rows", "_values")}
    return joined.withColumns(whole).drop("_rows_before", "_values_before", SLICE)


def _rank_by_counts(
    df: DataFrame, part: Sequence[str], order: Sequence[str], tie: Sequence[str], tiles: int, desc: bool, max_rows: int | None
) -> DataFrame:
    """Ranks of hot groups from their counted values; a value held by too many rows is itself cut along the tie."""
    peers, equals = _directed(order, desc), [*part, *order]
    total_order = [*peers, *tie]
    # Rows per distinct value, combined before the shuffle, and what comes before each value.
    counted = df.groupBy(*equals).agg(F.count("*").alias("_n"))
    totals = counted.groupBy(*part).agg(F.sum("_n").alias("_total"))
    values = materialise(_value_ranks(counted, part, peers, max_rows).drop("_n"), "ranked-values")
    cut = _cut(df, equals, [F.col(c) for c in tie], max_rows)
    if cut is None:
        at = F.row_number().over(Window.partitionBy(*equals).orderBy(*total_order)).cast("long")
        numbered = df.withColumn("_at", at)
    else:
        numbered = _numbered(cut, equals, total_order, "_at").drop(SLICE)
    joined = _attach(_attach(numbered, values, equals), materialise(totals, "group-totals"), part)
    joined = joined.withColumns(
        {
            "row_number": F.col("_rows") + F.col("_at"),
            "rank": F.col("_rows") + 1,
            "dense_rank": F.col("_values") + 1,
        }
    )
    # The first `long` tiles have one row more than the others.
    size, long = F.floor(F.col("_total") / tiles), F.col("_total") % tiles
    head = long * (size + 1)
    tile = F.when(F.col("row_number") <= head, F.floor((F.col("row_number") - 1) / (size + 1)) + 1).otherwise(
        long + F.floor((F.col("row_number") - 1 - head) / F.greatest(size, F.lit(1))) + 1
    )
    spread = F.when(F.col("_total") > 1, (F.col("rank") - 1) / (F.col("_total") - 1)).otherwise(F.lit(0.0))
    ranked = joined.withColumns({"percent_rank": spread, "ntile": tile})
    whole = {c: F.col(c).cast("int") for c in ("row_number", "rank", "dense_rank", "ntile")}
    return ranked.withColumns(whole).drop("_rows", "_values", "_at", "_total")


def rank_in(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    tie: Sequence[str],
    tiles: int = 4,
    desc: bool = False,
    max_rows: int | None = None,
) -> DataFrame:
    """row_number, rank, dense_rank, percent_rank and ntile. ``tie`` makes the order total.

    Hot groups are ranked from the counts of their distinct order values, so that rows of one value need not be in one task:
    ``row_number`` is the rows before the value plus the place among its equals, and many equals are cut along ``tie``.
    """
    peers, total_order = _directed(order, desc), [*_directed(order, desc), *tie]
    by_peers, by_rows = Window.partitionBy(*part).orderBy(*peers), Window.partitionBy(*part).orderBy(*total_order)
    plain = {
        "row_number": F.row_number().over(by_rows),
        "rank": F.rank().over(by_peers),
        "dense_rank": F.dense_rank().over(by_peers),
        "percent_rank": F.percent_rank().over(by_peers),
        "ntile": F.ntile(tiles).over(by_rows),
    }
    hot = hot_counts(df, part, max_rows)
    if not hot:
        return df.withColumns(plain)
    is_hot = in_groups(part, list(hot))
    ranked = _rank_by_counts(df.where(is_hot), part, order, tie, tiles, desc, max_rows)
    return df.where(~is_hot).withColumns(plain).unionByName(ranked)


def _blocks(cut: _Cut, part: Sequence[str], order: Sequence[str], back: int, ahead: int, size: int) -> DataFrame:
    """Hot groups in equal blocks of rows, each with a copy of the ``back`` rows before and ``ahead`` rows after it.

    ``_own`` marks the original of each row, ``_rn`` is its number in the group. No row is
    copied more than twice because a block is at least as long as the frame. A normal group
    is one block.
    """
    numbered = _numbered(cut, part, order, RN)
    size = max(size, back, ahead, 1)
    hot, at = F.col(SLICE) >= 0, F.col(RN) - 1
    home = F.when(hot, F.floor(at / size)).otherwise(F.lit(0))
    offset = at % size
    places = F.array(
        home,
        F.when(hot & (offset >= size - back), home + 1) if back else F.lit(None).cast("long"),
        F.when(hot & (offset < ahead) & (home > 0), home - 1) if ahead else F.lit(None).cast("long"),
    )
    copied = numbered.withColumn("_home", home).withColumn("_block", F.explode(F.array_compact(places)))
    return copied.withColumn("_own", F.col("_block") == F.col("_home"))


def _by_rows(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    back: int,
    ahead: int,
    exprs: Callable[[WindowSpec], dict[str, Column]],
    max_rows: int | None,
) -> DataFrame:
    """Evaluate frames of a fixed number of rows. ``exprs`` maps an ordered window to named columns."""
    cut = _cut(df, part, _directed(order, False), max_rows)
    if cut is None:
        return df.withColumns(exprs(Window.partitionBy(*part).orderBy(*order)))
    blocks = _blocks(cut, part, order, back, ahead, hot_rows(df.sparkSession, max_rows))
    result = blocks.withColumns(exprs(Window.partitionBy(*part, "_block").orderBy(RN)))
    return result.where("_own").drop(RN, SLICE, "_home", "_block", "_own")


def shift_in(
    df: DataFrame, part: Sequence[str], order: Sequence[str], column: str, n: int = 1, max_rows: int | None = None
) -> DataFrame:
    """lag and lead by ``n`` rows, and the first and last value of the group."""
    first, last = f"first_{column}", f"last_{column}"

    def exprs(w: WindowSpec) -> dict[str, Column]:
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return {
            f"lag_{column}": F.lag(column, n).over(w),
            f"lead_{column}": F.lead(column, n).over(w),
            first: F.first(column).over(whole),
            last: F.last(column).over(whole),
        }

    cut = _cut(df, part, _directed(order, False), max_rows)
    if cut is None:
        return df.withColumns(exprs(Window.partitionBy(*part).orderBy(*order)))
    blocks = _blocks(cut, part, order, n, n, hot_rows(df.sparkSession, max_rows))
    shifted = blocks.withColumns(exprs(Window.partitionBy(*part, "_block").orderBy(RN))).where("_own")
    # The ends of a hot group lie in other blocks; they are found with a partial aggregate.
    at = F.struct(*order)
    ends = cut.rows.where(F.col(SLICE) >= 0).groupBy(*part).agg(
        F.min_by(F.struct(column), at).alias("_first"), F.max_by(F.struct(column), at).alias("_last")
    )
    joined = cut.attach(shifted, ends, part)
    fixed = {
        first: F.when(F.col("_first").isNull(), F.col(first)).otherwise(F.col(f"_first.{column}")),
        last: F.when(F.col("_last").isNull(), F.col(last)).otherwise(F.col(f"_last.{column}")),
    }
    return joined.withColumns(fixed).drop(RN, SLICE, "_home", "_block", "_own", "_first", "_last")


def running(
    df: DataFrame, part: Sequence[str], order: Sequence[str], value: Column, name: str, max_rows: int | None = None
) -> DataFrame:
    """Running total in a total order."""
    df = df.withColumn("_value", value)
    cut = _cut(df, part, _directed(order, False), max_rows)
    to_here = lambda *by: Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn(name, F.sum("_value").over(to_here(*part)))
    if cut is None:
        return plain.drop("_value")
    local = cut.rows.withColumn(name, F.sum("_value").over(to_here(*part, SLICE)))
    joined = cut.attach(local, cut.sums_before(part, {"_before": F.sum("_value")}), [*part, SLICE])
    # A sum over no values is null, so the total is null only where both parts are.
    both = F.col(name) + F.col("_before")
    whole = F.coalesce(both, F.col(name), F.col("_before")).cast(plain.schema[name].dataType)
    return joined.withColumn(name, whole).drop("_before", "_value", SLICE)


def moving_rows(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    rows: int,
    max_rows: int | None = None,
) -> DataFrame:
    """Sum over the current row and the ``rows`` before it."""
    exprs = lambda w: {name: F.sum("_value").over(w.rowsBetween(-rows, 0))}
    return _by_rows(df.withColumn("_value", value), part, order, rows, 0, exprs, max_rows).drop("_value")


def moving_range(
    df: DataFrame, part: Sequence[str], ts: str, value: Column, name: str, seconds: int, max_rows: int | None = None
) -> DataFrame:
    """Sum over the rows of the last ``seconds`` up to the current row's time, ties included."""
    span = seconds * 1_000_000
    timed = df.withColumns({"_value": value, "_at": micros(df, ts)})
    in_frame = lambda *by: Window.partitionBy(*by).orderBy("_at").rangeBetween(-span, 0)
    cut = _cut(timed, part, [F.col("_at").asc()], max_rows)
    plain = timed.withColumn(name, F.sum("_value").over(in_frame(*part)))
    if cut is None:
        return plain.drop("_value", "_at")
    # Each slice starts at its first time. A row is copied into every later slice that starts within its reach.
    # Equal times share a slice and are summed first, so the copies are at most one row per distinct time.
    own = cut.rows.withColumn("_own", F.lit(True))
    starts = cut.per_slice(part, {"_start": F.min("_at")})
    sums = cut.rows.where((F.col(SLICE) >= 0) & F.col("_at").isNotNull()).groupBy(*part, SLICE, "_at").agg(F.sum("_value").alias("_value"))
    later = starts.select(*[F.col(c).alias(f"_l_{c}") for c in part], F.col(SLICE).alias("_later"), F.col("_start").alias("_later_start"))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_l_{c}")) for c in part])
    # Slice starts are one row per slice; the reach of a slice ends at its last time plus the frame.
    ends = cut.per_slice(part, {"_end": F.max("_at")}).select(*part, SLICE, "_end")
    reach = ends.join(later, same & (F.col("_later") > F.col(SLICE)) & (F.col("_later_start") <= F.col("_end") + span))
    reach = reach.select(*part, SLICE, "_later", "_later_start")
    lead = _attach(sums, reach, [*part, SLICE]).where(F.col("_later_start") <= F.col("_at") + span)
    lead = lead.select(*part, F.col("_later").alias(SLICE), "_at", "_value", F.lit(False).alias("_own"))
    both = own.unionByName(lead, allowMissingColumns=True)
    result = both.withColumn(name, F.sum("_value").over(in_frame(*part, SLICE)).cast(plain.schema[name].dataType))
    return result.where("_own").drop("_value", "_at", "_own", SLICE)


def running_extreme(
    df: DataFrame, part: Sequence[str], order: Sequence[str], column: str, name: str,
    pick: str = "max", desc: bool = False, max_rows: int | None = None,
) -> DataFrame:
    """Running minimum or maximum (``pick``) of ``column`` in a total order; nulls are skipped."""
    take, merge = {"max": (F.max, F.greatest), "min": (F.min, F.least)}[pick]
    directed = _directed(order, desc)
    to_here = lambda *by: Window.partitionBy(*by).orderBy(*directed).rowsBetween(Window.unboundedPreceding, 0)
    cut = _cut(df, part, directed, max_rows)
    if cut is None:
        return df.withColumn(name, take(column).over(to_here(*part)))
    local = cut.rows.withColumn(name, take(column).over(to_here(*part, SLICE)))
    best = cut.per_slice(part, {"_best": take(column)})
    earlier = Window.partitionBy(*part).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = best.select(*part, SLICE, take("_best").over(earlier).alias("_before"))
    joined = cut.attach(local, before, [*part, SLICE])
    return joined.withColumn(name, merge(name, "_before")).drop("_before", SLICE)


def _sliding_extreme(points: DataFrame, part: Sequence[str], span: int, name: str, pick: str, max_rows: int | None) -> DataFrame:
    """Extreme of ``_value`` over the points in [_at - span, _at]; ``_at`` is a whole number, distinct in its group.

    Time is cut in blocks as long as the frame. A frame is the start of its own block up to the point and the end of the block before
    it from ``_at - span`` on. Both are running extremes, so each point is touched a fixed number of times however long the frame is.
    """
    if not span:
        return points.withColumn(name, F.col("_value"))
    merge = F.greatest if pick == "max" else F.least
    block = [*part, "_block"]
    points = points.withColumn("_block", F.col("_at") - F.pmod("_at", F.lit(span)))
    heads = running_extreme(points, block, ["_at"], "_value", "_head", pick, max_rows=max_rows).withColumn("_own", F.lit(1))
    tails = running_extreme(points, block, ["_at"], "_value", "_tail", pick, desc=True, max_rows=max_rows)
    # The tail that starts at a point serves the points up to ``span`` later, all of them in the next block.
    moved = tails.where(F.col("_at").isNotNull()).select(
        *part, (F.col("_block") + span).alias("_block"), (F.col("_at") + span).alias("_at"), "_tail", F.lit(0).alias("_own")
    )
    both = heads.unionByName(moved, allowMissingColumns=True).withColumn("_back", -F.col("_at"))
    found = carry_last(both, block, ["_back", "_own"], "_tail", "_lead", max_rows).where(F.col("_own") == 1)
    return found.withColumn(name, merge("_head", "_lead")).drop("_block", "_head", "_tail", "_own", "_back", "_lead")


def moving_rows_extreme(
    df: DataFrame, part: Sequence[str], order: Sequence[str], value: Column, name: str, rows: int,
    pick: str = "max", max_rows: int | None = None,
) -> DataFrame:
    """Minimum or maximum over the current row and the ``rows`` before it, in a total order."""
    df = df.withColumn("_value", value)
    cut = _cut(df, part, _directed(order, False), max_rows)
    if cut is None:
        numbered = df.withColumn("_at", F.row_number().over(Window.partitionBy(*part).orderBy(*order)).cast("long"))
    else:
        numbered = _numbered(cut, part, order, "_at").drop(SLICE)
    return _sliding_extreme(numbered, part, rows, name, pick, max_rows).drop("_value", "_at")


def moving_range_extreme(
    df: DataFrame, part: Sequence[str], ts: str, value: Column, name: str, seconds: int,
    pick: str = "max", max_rows: int | None = None,
) -> DataFrame:
    """Minimum or maximum over the last ``seconds`` up to the current row's time, ties included. Rows without a time see each other only."""
    take = F.max if pick == "max" else F.min
    timed = df.withColumns({"_value": value, "_at": micros(df, ts)})
    # Equal times have equal frames: one point each, combined before the shuffle.
    points = timed.groupBy(*part, "_at").agg(take("_value").alias("_value"))
    found = _sliding_extreme(points, part, seconds * 1_000_000, name, pick, max_rows).drop("_value")
    return _attach(timed.drop("_value"), found, [*part, "_at"]).drop("_at")


def lead_in(
    df: DataFrame, part: Sequence[str], order: Sequence[str], column: str, name: str, max_rows: int | None = None
) -> DataFrame:
    """The value of ``column`` in the next row of the group."""
    return _by_rows(df, part, order, 0, 1, lambda w: {name: F.lead(column).over(w)}, max_rows)


def share_in(df: DataFrame, part: Sequence[str], value: Column, name: str) -> DataFrame:
    """Share of the group total, by joining the pre-aggregated totals back."""
    totals = df.groupBy(*part).agg(F.sum(value).alias("_total"))
    return _attach(df, totals, part).withColumn(name, value / F.nullif("_total", F.lit(0))).drop("_total")


def top_n_per(df: DataFrame, part: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows per group. Each task keeps only ``n`` rows per group before the shuffle."""
    ranked = df.withColumn(RN, F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    return ranked.where(F.col(RN) <= n).drop(RN)


def carry_last(
    df: DataFrame, part: Sequence[str], order: Sequence[str], column: str, name: str, max_rows: int | None = None
) -> DataFrame:
    """The last non-null ``column`` at or before each row."""
    to_here = lambda *by: Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cut = _cut(df, part, _directed(order, False), max_rows)
    if cut is None:
        return df.withColumn(name, F.last(column, ignorenulls=True).over(to_here(*part)))
    local = cut.rows.withColumn(name, F.last(column, ignorenulls=True).over(to_here(*part, SLICE)))
    seen_at = F.when(F.col(column).isNotNull(), F.struct(*order))
    newest = cut.per_slice(part, {"_newest": F.max_by(column, seen_at)})
    earlier = Window.partitionBy(*part).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = newest.select(*part, SLICE, F.last("_newest", ignorenulls=True).over(earlier).alias("_before"))
    joined = cut.attach(local, before, [*part, SLICE])
    return joined.withColumn(name, F.coalesce(name, "_before")).drop("_before", SLICE)
