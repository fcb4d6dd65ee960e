"""Table layouts that several queries read. Each is written once per application and folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftline.session import scratch
from weftline.sources.layout import write_partitioned
from weftline.sources.tables import load

_written: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """The path that ``write`` filled on the first call. It outlives a scratch scope, since later calls hand it out again."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        path = scratch(spark, label, keep=True)
        write(path)
        _written[key] = path
    return _written[key]


def with_month(orders: DataFrame) -> DataFrame:
    return orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})


def orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` partitioned by year and month of the order date."""

    def write(path: str) -> None:
        write_partitioned(with_month(load(spark, sf_dir, "orders")), path, ["year", "month"])

    return spark.read.parquet(once(spark, sf_dir, "orders-by-month", write))
