"""Catalog tables: partitioned, bucketed, inserted into, analysed."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftline.operators.skew import HOT_ROWS, SALT, hot_counts, hot_rows, in_groups, replicate_hot, salts_for, spread_hot
from weftline.sources.layout import rebalance


DROP_BATCH = 1_000


def create_partitioned_table(spark: SparkSession, name: str, columns: str, by: Sequence[str]) -> None:
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(by)})")


def insert_into(df: DataFrame, table: str) -> None:
    """Insert by column name: the positional rule of ``insertInto`` never sees a wrong order."""
    columns = df.sparkSession.table(table).columns
    missing = set(columns) ^ set(df.columns)
    if missing:
        raise ValueError(f"columns differ from {table}: {sorted(missing)}")
    df.select(*columns).write.insertInto(table)


def insert_partition(df: DataFrame, table: str, spec: Mapping[str, object]) -> None:
    """Insert into one named partition; ``df`` carries the other columns only."""
    spark = df.sparkSession
    columns = [c for c in spark.table(table).columns if c not in spec]
    named = ", ".join(f"{k} = {_literal(v)}" for k, v in spec.items())
    spark.sql(f"INSERT INTO {table} PARTITION ({named}) SELECT {', '.join(columns)} FROM {{rows}}", rows=df)


def _literal(value: object) -> str:
    if value is None:
        return "null"
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def add_partition(spark: SparkSession, table: str, spec: Mapping[str, object]) -> None:
    named = ", ".join(f"{k} = {_literal(v)}" for k, v in spec.items())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({named})")


def list_partitions(spark: SparkSession, table: str, where: Column | None = None) -> DataFrame:
    """The partition values of a table as typed columns, from the catalog alone."""
    fields = [f for f in spark.table(table).schema if f.name in _partition_columns(spark, table)]
    pairs = F.str_to_map("partition", F.lit("/"), F.lit("="))
    # A value is stored URL-escaped in the partition name; the null value has a fixed name.
    values = [
        F.url_decode(F.nullif(pairs[f.name], F.lit("__HIVE_DEFAULT_PARTITION__"))).cast(f.dataType).alias(f.name)
        for f in fields
    ]
    listed = spark.sql(f"SHOW PARTITIONS {table}").select(*values)
    return listed if where is None else listed.where(where)


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def drop_partition(spark: SparkSession, table: str, spec: Mapping[str, object]) -> int:
    """Drop every partition that matches ``spec``, which may name only some of the columns; null names the null partition.

    The matches are read from the catalog in batches and dropped with one statement per ``DROP_BATCH`` of them.
    """
    by = _partition_columns(spark, table)
    listed = list_partitions(spark, table)
    where = reduce(lambda x, y: x & y, [F.col(n).eqNullSafe(F.lit(v).cast(listed.schema[n].dataType)) for n, v in spec.items()])
    dropped = 0
    for batch in _batches(listed.where(where).toLocalIterator(), DROP_BATCH):
        named = ", ".join("PARTITION (" + ", ".join(f"{c} = {_literal(row[c])}" for c in by) + ")" for row in batch)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {named}")
        dropped += len(batch)
    return dropped


def _batches(rows: Iterable, size: int) -> Iterator[list]:
    rows = iter(rows)
    while batch := list(islice(rows, size)):
        yield batch


def repair(spark: SparkSession, table: str) -> None:
    """Register the partition directories that were written past the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def write_bucketed(
    df: DataFrame, table: str, n: int, key: Sequence[str], partition_by: Sequence[str] = ()
) -> None:
    """Hash-clustered, sorted table. Rows are first shuffled by bucket, so a bucket is one file per partition."""
    if partition_by:
        # The hash is the one that assigns buckets; the rebalance splits an oversized bucket.
        by_bucket = df.withColumn("_bucket", F.pmod(F.hash(*key), F.lit(n)))
        writer = rebalance(by_bucket, *partition_by, "_bucket").drop("_bucket").write.partitionBy(*partition_by)
    else:
        writer = df.repartition(n, *key).write
    writer.bucketBy(n, *key).sortBy(*key).saveAsTable(table)


def write_join_pair(
    big: DataFrame,
    small: DataFrame,
    key: str,
    tables: tuple[str, str],
    buckets: int,
    row_id: str,
    max_rows: int | None = None,
) -> None:
    """Two tables bucketed alike, for joins without any exchange.

    A bucket cannot be split at run time, so a hot key would make one bucket hold
    most of the rows. Both tables are bucketed on ``(key, salt)``: the rows of a hot
    key get different salts on the big side and one copy per salt on the small side;
    all other rows have salt 0.
    """
    hot = hot_counts(big, [key], max_rows)
    is_hot, salts = in_groups([key], list(hot)), salts_for(hot, hot_rows(big.sparkSession, max_rows))
    write_bucketed(spread_hot(big, is_hot, [row_id], salts), tables[0], buckets, [key, SALT])
    write_bucketed(replicate_hot(small, is_hot, salts), tables[1], buckets, [key, SALT])


def buckets_for(df: DataFrame, rows_per_bucket: int = HOT_ROWS, at_least: int = 8) -> int:
    return max(at_least, math.ceil(df.count() / rows_per_bucket))


def bucketed_join(spark: SparkSession, tables: tuple[str, str], key: str) -> DataFrame:
    return spark.table(tables[0]).join(spark.table(tables[1]).hint("merge"), [key, SALT]).drop(SALT)


def column_stats(spark: SparkSession, table: str, columns: Sequence[str], histogram: bool = False) -> DataFrame:
    """Gather optimizer statistics and return them, one row per column.

    min, max and nulls are exact; the number of distinct values is an estimate. ``histogram`` adds the equi-height bins.
    """
    before = spark.conf.get("spark.sql.statistics.histogram.enabled")
    spark.conf.set("spark.sql.statistics.histogram.enabled", str(histogram).lower())
    try:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    finally:
        spark.conf.set("spark.sql.statistics.histogram.enabled", before)
    stats = None
    for column in columns:
        one = spark.sql(f"DESCRIBE EXTENDED {table} {column}").select(
            F.lit(column).alias("column_name"), "info_name", "info_value"
        )
        stats = one if stats is None else stats.unionByName(one)
    wanted = ["min", "max", "num_nulls", "distinct_count"] + ["histogram"] * histogram
    return stats.groupBy("column_name").pivot("info_name", wanted).agg(F.first("info_value"))
