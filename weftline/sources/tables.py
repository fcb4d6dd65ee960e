"""Reading and writing plain file tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def load(spark: SparkSession, sf_dir: str, name: str, row_id: str | None = None) -> DataFrame:
    """Parquet scan. ``row_id`` adds a stable id per stored row (file and position in it).

    The id does not change when a task is run again, and identical rows get
    different ids, so it is a safe source of salt.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if row_id:
        df = df.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(row_id))
    return df


def widen(df: DataFrame) -> DataFrame:
    """Spread the rows of a few files over all cores, before work that is heavy per row.

    A file of one row group is read by one task. A table of many files is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def gen_range(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(0, n)


def query(spark: SparkSession, text: str, args: dict | None = None, **views: DataFrame) -> DataFrame:
    """SQL text over the given frames (bound by name) with named parameters."""
    return spark.sql(text, args=args, **views) if views else spark.sql(text, args=args)


def write(df: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet", **options: str) -> None:
    df.write.format(fmt).mode(mode).options(**options).save(path)


def append(df: DataFrame, path: str) -> None:
    write(df, path, mode="append")


def read_format(spark: SparkSession, path: str, fmt: str, schema: StructType, **options: str) -> DataFrame:
    """ORC, JSON or CSV with a declared schema, so that no inference pass reads the files."""
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def read_evolved(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of one table whose later generations have more columns; absent columns read as null."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)
