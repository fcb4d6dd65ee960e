"""Reuse of an intermediate result."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` for the block and always release it. Lost blocks are computed again from the source.

    Results must be written or collected inside the block: later reads would compute everything anew.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def refresh(spark: SparkSession, path: str, old: DataFrame | None = None) -> DataFrame:
    """Read ``path`` again after its files changed, dropping what was cached of it."""
    if old is not None:
        old.unpersist()
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)
