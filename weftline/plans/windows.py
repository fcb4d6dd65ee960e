"""Window queries over the orders of each customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.functions.scalars import money
from weftline.operators import windows as W
from weftline.plans.registry import query
from weftline.sources.tables import load

PART = ["o_custkey"]
ORDER = ["o_orderdate", "o_orderkey"]


def _orders(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query(
    "win_rank",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS INTEGER) AS row_number,
       CAST(rank() OVER p AS INTEGER) AS rank, CAST(dense_rank() OVER p AS INTEGER) AS dense_rank,
       percent_rank() OVER p AS percent_rank,
       CAST(ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS INTEGER) AS ntile
       FROM orders WINDOW p AS (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST)""",
)
def win_rank(spark, sf_dir):
    return W.rank_in(_orders(spark, sf_dir), PART, ["o_orderdate"], tie=["o_orderkey"], tiles=4)


@query(
    "win_lag_lead",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, lag(o_totalprice) OVER w AS lag_o_totalprice,
       lead(o_totalprice) OVER w AS lead_o_totalprice,
       first_value(o_totalprice) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_o_totalprice,
       last_value(o_totalprice) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_o_totalprice
       FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST)""",
)
def win_lag_lead(spark, sf_dir):
    return W.shift_in(_orders(spark, sf_dir), PART, ORDER, "o_totalprice", 1)


@query(
    "win_running",
    """SELECT o_custkey, o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) OVER
       (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM orders""",
)
def win_running(spark, sf_dir):
    summed = W.running(_orders(spark, sf_dir), PART, ORDER, money("o_totalprice"), "running")
    return summed.select("o_custkey", "o_orderkey", F.col("running").cast("double").alias("running"))


@query(
    "win_moving_rows",
    """SELECT o_custkey, o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) OVER
       (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS moving FROM orders""",
)
def win_moving_rows(spark, sf_dir):
    summed = W.moving_rows(_orders(spark, sf_dir), PART, ORDER, money("o_totalprice"), "moving", rows=2)
    return summed.select("o_custkey", "o_orderkey", F.col("moving").cast("double").alias("moving"))


@query(
    "win_moving_range",
    """SELECT event_id, user_id, CAST(sum(CAST(value AS DECIMAL(12,2))) OVER
       (PARTITION BY user_id ORDER BY ts NULLS FIRST RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS DOUBLE) AS last_day FROM events""",
)
def win_moving_range(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    summed = W.moving_range(events, ["user_id"], "ts", money("value"), "last_day", seconds=86_400)
    return summed.select("event_id", "user_id", F.col("last_day").cast("double").alias("last_day"))


@query(
    "win_moving_extremes",
    """SELECT event_id, user_id, ts, value, max(value) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST
       RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS day_high,
       min(value) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS low FROM events""",
)
def win_moving_extremes(spark, sf_dir):
    """Highest value of the last day and lowest of the last 21 events: frames whose oldest row cannot be subtracted."""
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    low = W.moving_rows_extreme(events, ["user_id"], ["ts", "event_id"], F.col("value"), "low", rows=20, pick="min")
    return W.moving_range_extreme(low, ["user_id"], "ts", F.col("value"), "day_high", seconds=86_400)


@query(
    "win_share",
    """SELECT o_custkey, o_orderkey, round(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) /
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) OVER (PARTITION BY o_custkey) AS DOUBLE), 9) AS share FROM orders""",
)
def win_share(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    shared = W.share_in(orders.withColumn("price", money("o_totalprice")), PART, F.col("price"), "exact")
    return shared.select("o_custkey", "o_orderkey", F.round(F.col("exact").cast("double"), 9).alias("share"))


@query(
    "win_topn",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey NULLS FIRST) <= 3""",
)
def win_topn(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return W.top_n_per(orders, PART, [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)
