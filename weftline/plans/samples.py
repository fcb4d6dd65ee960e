"""Repeatable random numbers and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import samples as R
from weftline.plans.registry import query
from weftline.sources.tables import load


def _uniform_sql(row_id: str, seed: int) -> str:
    bits = f"CAST('0x' || substr(md5('{seed}:' || coalesce(CAST({row_id} AS VARCHAR), '')), 1, {R.BITS // 4}) AS BIGINT)"
    return f"(({bits} + CAST(0.5 AS DOUBLE)) / CAST({1 << R.BITS} AS DOUBLE))"


@query("fn_random", f"SELECT o_orderkey, {_uniform_sql('o_orderkey', 7)} AS draw FROM orders WHERE {_uniform_sql('o_orderkey', 3)} < 0.25")
def fn_random(spark, sf_dir):
    """A quarter of the orders, with a random number each."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    return R.sample_share(orders, 0.25, ["o_orderkey"], seed=3).withColumn("draw", R.uniform(["o_orderkey"], seed=7))


@query(
    "sample_per_group",
    f"""SELECT o_custkey, o_orderkey FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {_uniform_sql('o_orderkey', 1)}, o_orderkey NULLS FIRST) <= 3""",
)
def sample_per_group(spark, sf_dir):
    """Three orders of each customer."""
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return R.sample_per_group(orders, ["o_custkey"], 3, ["o_orderkey"], seed=1)


@query(
    "sample_weighted",
    f"""SELECT o_orderpriority, o_orderkey FROM orders WHERE o_totalprice > 0
        QUALIFY row_number() OVER (PARTITION BY o_orderpriority
        ORDER BY -ln({_uniform_sql('o_orderkey', 2)}) / o_totalprice, o_orderkey NULLS FIRST) <= 50""",
)
def sample_weighted(spark, sf_dir):
    """Fifty orders of each priority, dear ones with better chances."""
    orders = load(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", F.col("o_totalprice").alias("w"))
    return R.sample_per_group(orders, ["o_orderpriority"], 50, ["o_orderkey"], seed=2, weight="w").drop("w")
