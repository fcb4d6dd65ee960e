"""Physical layout: directory partitions, overwrite modes, compaction, file census."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftline.operators.joins import broadcast_if_small, null_safe

SMALL_FILE = 10 * 1024 * 1024
TARGET_FILE = 512 * 1024 * 1024


def rebalance(df: DataFrame, *cols: str) -> DataFrame:
    """Partitions of similar size: adaptive execution merges small ones and splits large ones."""
    return df.hint("rebalance", *cols) if cols else df.hint("rebalance")


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], mode: str = "errorifexists") -> None:
    """Hive layout ``col=value/``.

    Rows are first brought together by partition value, so a task writes few
    directories; the rebalance splits a value that is too large for one task.
    """
    rebalance(df, *cols).write.mode(mode).partitionBy(*cols).parquet(path)


def overwrite(df: DataFrame, path: str, cols: Sequence[str], mode: str = "static") -> None:
    """``static`` replaces the whole table, ``dynamic`` only the partitions present in ``df``."""
    if mode not in ("static", "dynamic"):
        raise ValueError(f"overwrite mode {mode!r}")
    writer = rebalance(df, *cols).write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(*cols).parquet(path)


def overwrite_partition(df: DataFrame, path: str, spec: Mapping[str, object]) -> None:
    """Replace the one partition named by ``spec`` (all partition columns) with the rows of ``df`` that belong to it.

    A null value names the partition of null. Without such rows the partition is left empty.
    """
    spark = df.sparkSession
    same = lambda frame: null_safe([(F.col(n), F.lit(v).cast(frame.schema[n].dataType)) for n, v in spec.items()])
    rows = df.where(same(df))
    if not rows.isEmpty():
        overwrite(rows, path, list(spec), "dynamic")
        return
    listed = files(spark, path)
    for row in listed.where(same(listed)).select(F.regexp_extract("path", "^(.*)/", 1).alias("leaf")).distinct().collect():
        rows.drop(*spec).write.mode("overwrite").parquet(row["leaf"])


def years(c: Column | str) -> Column:
    return F.year(c)


def months(c: Column | str) -> Column:
    return F.year(c) * 12 + F.month(c) - 1


def days(c: Column | str) -> Column:
    return F.to_date(c)


def bucket(n: int, *cols: Column | str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def write_transform_partitioned(df: DataFrame, path: str, transforms: Mapping[str, Column]) -> None:
    """Partition by derived columns that the reader of the table never sees."""
    clash = set(transforms) & set(df.columns)
    if clash:
        raise ValueError(f"derived partition columns clash with table columns: {sorted(clash)}")
    write_partitioned(df.withColumns(dict(transforms)), path, list(transforms))


def read_transform_partitioned(
    spark: SparkSession, path: str, derived: Sequence[str], where: Column | None = None
) -> DataFrame:
    """Read such a table. ``where`` may use the derived columns and is pruned by directory."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.drop(*derived)


def files(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file: path, length and the partition values. Only the listing is read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listing.drop("content", "modificationTime")


def file_census(spark: SparkSession, path: str, cols: Sequence[str], small: int = SMALL_FILE) -> DataFrame:
    return (
        files(spark, path)
        .groupBy(*cols)
        .agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
            F.avg("length").alias("avg_bytes"),
            F.count(F.when(F.col("length") < small, 1)).alias("small_files"),
        )
    )


def compact(spark: SparkSession, src: str, dst: str, cols: Sequence[str], target: int = TARGET_FILE) -> None:
    """Rewrite ``src`` into ``dst`` with about one file per ``target`` bytes in each partition.

    Large partitions get several files: their rows are spread by a stable row id,
    so no single task writes a whole partition. An empty table without any partition has nothing to rewrite.
    """
    if not set(cols) <= set(files(spark, src).columns):
        return
    wanted = file_census(spark, src, cols).select(
        *[F.col(c).alias(f"_{c}") for c in cols],
        F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(target))).cast("int").alias("_files"),
    )
    total = wanted.agg(F.sum("_files")).first()[0] or 1
    rows = spark.read.parquet(src).select(
        "*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_row")
    )
    kept = [c for c in rows.columns if c != "_row"]
    if not cols:
        rows.repartition(int(total), "_row").select(*kept).write.parquet(dst)
        return
    same = null_safe([(F.col(c), F.col(f"_{c}")) for c in cols])
    spread = (
        rows.join(broadcast_if_small(wanted), same)
        .withColumn("_part", F.pmod("_row", "_files"))
        .repartition(int(total), *cols, "_part")
    )
    spread.select(*kept).write.partitionBy(*cols).parquet(dst)
