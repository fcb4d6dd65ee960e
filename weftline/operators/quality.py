"""Data quality: schema contracts, profiles, reconciliation, rules, anomalies, nulls."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from weftline.operators.joins import anti_join
from weftline.operators.windows import _attach


def _stacked(wide: DataFrame, cells: Sequence[tuple], names: str) -> DataFrame:
    """One row of many aggregates into one row per entry of ``cells``."""
    rows = [F.struct(*[c.alias(n) for n, c in zip(names.split(), cell)]) for cell in cells]
    return wide.select(F.inline(F.array(*rows)))


def check_schema(df: DataFrame, contract: T.StructType) -> DataFrame:
    """One row per violation: missing, unexpected or wrongly typed columns, and text that does not parse.

    A text column whose contract type differs is read as that type; ``rows`` counts the
    values that cannot be. Structure needs no data, the values need one pass.
    """
    actual = {f.name: f.dataType for f in df.schema}
    wanted = {f.name: f.dataType for f in contract}
    found: list[tuple[str, str, Column]] = []
    none = F.lit(None).cast("long")
    for name, kind in wanted.items():
        if name not in actual:
            found.append((name, "missing", none))
        elif actual[name] != kind:
            found.append((name, "type", none))
    found += [(name, "unexpected", none) for name in actual if name not in wanted]
    parsed = [n for n, kind in wanted.items() if isinstance(actual.get(n), T.StringType) and actual[n] != kind]
    if parsed:
        bad = [F.count(F.when(F.col(n).isNotNull() & F.col(n).try_cast(wanted[n]).isNull(), 1)).alias(n) for n in parsed]
        counted = df.agg(*bad)
    else:
        counted = df.sparkSession.range(1)
    cells = [(F.lit(n), F.lit(p), r) for n, p, r in found] + [(F.lit(n), F.lit("unparsable"), F.col(n)) for n in parsed]
    if not cells:
        return counted.select(F.lit("").alias("column_name"), F.lit("").alias("problem"), none.alias("rows")).limit(0)
    rows = _stacked(counted, cells, "column_name problem rows")
    return rows.where((F.col("problem") != "unparsable") | (F.col("rows") > 0))


#: Values that one task of an exact profile looks at.
CELLS_PER_TASK = 1_000_000


def _distinct_counts(df: DataFrame) -> DataFrame:
    """One row with the exact number ``_d<i>`` of distinct values of each column.

    Every row is copied once per column and combined per task. Rows are spread before, by their hash, to tasks of a bounded number of values,
    so the memory of a task follows neither the table nor the size of its files; the copies carry no other aggregates.
    """
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() * len(df.columns) // CELLS_PER_TASK))
    spread = df.repartition(n, F.xxhash64(*[F.col(c) for c in df.columns]))
    return spread.agg(*[F.count_distinct(F.col(c)).alias(f"_d{i}") for i, c in enumerate(df.columns)])


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Rows, nulls, distinct values, min, max and mean of every column, in one pass.

    Distinct values are estimated. ``exact=True`` counts them, for which ``df`` is computed twice more.
    """
    aggs, cells = [F.count("*").alias("_rows")], []
    for i, field in enumerate(df.schema):
        c = F.col(field.name)
        aggs += [
            F.count(c).alias(f"_c{i}"),
            F.min(c).cast("string").alias(f"_lo{i}"),
            F.max(c).cast("string").alias(f"_hi{i}"),
        ]
        if not exact:
            aggs.append(F.approx_count_distinct(c).alias(f"_d{i}"))
        mean = F.lit(None).cast("double")
        if isinstance(field.dataType, T.IntegralType):
            # An exact sum does not depend on the order of the rows.
            aggs.append(F.sum(c.cast("decimal(38,0)")).cast("double").alias(f"_s{i}"))
            mean = F.col(f"_s{i}") / F.nullif(F.col(f"_c{i}"), F.lit(0))
        elif isinstance(field.dataType, T.NumericType):
            aggs.append(F.avg(c).cast("double").alias(f"_s{i}"))
            mean = F.col(f"_s{i}")
        values = [F.col("_rows"), F.col("_rows") - F.col(f"_c{i}"), F.col(f"_d{i}"), F.col(f"_lo{i}"), F.col(f"_hi{i}")]
        cells.append((F.lit(field.name), *values, mean))
    wide = df.agg(*aggs)
    if exact:
        wide = wide.crossJoin(_distinct_counts(df))
    return _stacked(wide, cells, "column_name rows nulls ndv min_value max_value mean")


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and a hash that does not depend on row order."""
    hashed = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.sum(hashed).alias("hash"))


def reconcile(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows on each side and rows found on one side only, counting repeated rows as often as they occur.

    Equal rows cancel out in one aggregation that is combined before the shuffle.
    """
    columns = a.columns
    both = a.withColumn("_sign", F.lit(1)).unionByName(b.withColumn("_sign", F.lit(-1)))
    net = both.groupBy(*columns).agg(F.sum("_sign").alias("_net"), F.count("*").alias("_all"))
    return net.agg(
        F.coalesce(F.sum((F.col("_all") + F.col("_net")) / 2), F.lit(0)).cast("long").alias("rows_a"),
        F.coalesce(F.sum((F.col("_all") - F.col("_net")) / 2), F.lit(0)).cast("long").alias("rows_b"),
        F.coalesce(F.sum(F.greatest("_net", F.lit(0))), F.lit(0)).alias("only_a"),
        F.coalesce(F.sum(F.greatest(-F.col("_net"), F.lit(0))), F.lit(0)).alias("only_b"),
    )


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class InRange:
    column: str
    lo: float
    hi: float


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    column: str
    dimension: DataFrame
    key: str


def check_rules(df: DataFrame, rules: dict[str, object]) -> DataFrame:
    """One row per rule with the number of violations.

    Row rules share one pass. ``Unique`` counts the keys that occur more than once,
    ``ForeignKey`` the rows whose non-null key is unknown.
    """
    row_rules, parts = {}, []
    for name, rule in rules.items():
        match rule:
            case NotNull(column):
                row_rules[name] = F.col(column).isNull()
            case InRange(column, lo, hi):
                row_rules[name] = ~F.col(column).between(lo, hi)
            case Unique(columns):
                repeated = df.groupBy(*columns).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
                parts.append((name, repeated))
            case ForeignKey(column, dimension, key):
                # Rows are counted per key first, so a frequent key is one row in the join.
                keys = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
                known = dimension.select(F.col(key).alias(column))
                parts.append((name, anti_join(keys, known, [column]).select("_n")))
            case _:
                raise TypeError(f"unknown rule {rule!r}")
    results = []
    if row_rules:
        counted = df.agg(*[F.count(F.when(bad, 1)).alias(name) for name, bad in row_rules.items()])
        results.append(_stacked(counted, [(F.lit(n), F.col(n)) for n in row_rules], "rule violations"))
    for name, frame in parts:
        total = F.count("*") if isinstance(rules[name], Unique) else F.coalesce(F.sum("_n"), F.lit(0))
        results.append(frame.agg(total.alias("violations")).select(F.lit(name).alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, results)


def anomalies(daily: DataFrame, part: Sequence[str], day: str, value: str, z: float = 3.0) -> DataFrame:
    """z-score of each day against its group, and the change from the day before.

    ``daily`` has one row per group and day. The score is null where the group does not vary.
    """
    x = F.col(value).cast("double")
    stats = daily.groupBy(*part).agg(F.avg(x).alias("_mean"), F.stddev_samp(x).alias("_spread"))
    # One row per day: a group is as long as the calendar, not as the data.
    change = F.col(value) - F.lag(value).over(Window.partitionBy(*part).orderBy(day))
    score = (F.col(value) - F.col("_mean")) / F.nullif("_spread", F.lit(0.0))
    scored = _attach(daily.withColumn("change", change), stats, part).withColumn("z", score)
    flagged = F.coalesce(F.abs("z") > z, F.lit(False)).alias("anomaly")
    return scored.select(*daily.columns, "change", "z", flagged)


def fill_nulls(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.na.fill(defaults)


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))
