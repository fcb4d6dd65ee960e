"""Joins on inequalities, mergeable summaries, comparison by hashes, and groups as streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from weftline.operators import compare as C, pandas_groups as P, sketches as K
from weftline.operators.inequality import inequality_join
from weftline.plans.registry import query
from weftline.session import materialise
from weftline.sources.tables import load


@query(
    "join_inequality",
    """SELECT p.event_id AS purchase_id, v.event_id AS view_id FROM events p JOIN events v
       ON p.ts <= v.ts + to_seconds(CAST(floor(v.value) AS BIGINT)) AND p.ts + to_seconds(CAST(floor(p.value) AS BIGINT)) >= v.ts
       WHERE p.event_type = 'purchase' AND v.event_type = 'view'""",
)
def join_inequality(spark, sf_dir):
    """Purchases and views that overlap in time; an event lasts as many seconds as its value says."""
    events = load(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.floor("value").alias("seconds"))
    end = F.col("ts") + F.make_dt_interval(secs=F.col("seconds"))
    lasting = events.withColumn("until", end)
    side = lambda kind, name: lasting.where(F.col("event_type") == kind).select(
        F.col("event_id").alias(f"{name}_id"), F.col("ts").alias(f"{name}_start"), F.col("until").alias(f"{name}_end")
    )
    met = inequality_join(
        side("purchase", "purchase"), side("view", "view"), ("purchase_start", "<=", "view_end"), ("purchase_end", ">=", "view_start")
    )
    return met.select("purchase_id", "view_id")


@query(
    "frequent_keys",
    """WITH c AS (SELECT l_returnflag || '_' || l_linestatus AS key, count(*) AS n FROM lineitem GROUP BY 1)
       SELECT key, n FROM c WHERE n > (SELECT sum(n) FROM c) * CAST(0.16 AS DOUBLE)""",
)
def frequent_keys(spark, sf_dir):
    key = F.concat_ws("_", "l_returnflag", "l_linestatus").alias("key")
    return K.frequent_keys(load(spark, sf_dir, "lineitem").select(key), ["key"], 0.16)


def _customers(spark, sf_dir) -> DataFrame:
    """Bitmaps of the customers of each year and priority, stored."""
    orders = load(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return materialise(K.distinct_bitmaps(orders, ["year", "o_orderpriority"], "o_custkey"), "customer-bitmaps")


@query(
    "sketch_rollup",
    """SELECT year(o_orderdate) AS year, NULL AS o_orderpriority, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1
       UNION ALL SELECT NULL, o_orderpriority, count(DISTINCT o_custkey) FROM orders GROUP BY 2
       UNION ALL SELECT NULL, NULL, count(DISTINCT o_custkey) FROM orders""",
)
def sketch_rollup(spark, sf_dir):
    """Distinct customers of several groupings from the stored bitmaps alone, exact for any number of customers."""
    stored = _customers(spark, sf_dir)
    found = [K.count_bits(stored, by) for by in (["year"], ["o_orderpriority"], [])]
    out = found[0].unionByName(found[1], allowMissingColumns=True).unionByName(found[2], allowMissingColumns=True)
    return out.select(F.col("year").cast("long").alias("year"), "o_orderpriority", F.col("distinct").alias("customers"))


@query(
    "sketch_overlap",
    """WITH c AS (SELECT o_custkey AS k, bool_or(o_orderpriority = '1-URGENT') AS a, bool_or(o_orderpriority = '5-LOW') AS b
       FROM orders GROUP BY 1) SELECT count(*) FILTER (a AND b) AS both, count(*) FILTER (a AND NOT b) AS only_a,
       count(*) FILTER (b AND NOT a) AS only_b, count(*) FILTER (a OR b) AS either FROM c WHERE k IS NOT NULL""",
)
def sketch_overlap(spark, sf_dir):
    """Customers with urgent orders, with low ones, and with both, by set operations on stored bitmaps; exact."""
    has = lambda name: F.col("o_orderpriority") == name
    return K.overlap_bits(_customers(spark, sf_dir), has("1-URGENT"), has("5-LOW"))


@query("quantile_histogram")
def quantile_histogram(spark, sf_dir):
    """Equal-height histogram of prices per year, from sketches per month that are stored and merged."""
    dated = load(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_totalprice")
    stored = materialise(K.quantile_sketches(dated, ["year", "month"], "o_totalprice"), "price-sketches")
    return K.histogram(K.merge_quantiles(stored, ["year"]), 20, ["year"])


@query(
    "dq_hash_tree",
    """WITH a AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders),
       b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 500 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
             FROM orders WHERE o_orderkey % 500 <> 8 OR o_orderkey IS NULL)
       SELECT *, 'before' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
       UNION ALL SELECT *, 'after', 1 FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def dq_hash_tree(spark, sf_dir):
    """Orders against a copy in which some rows have another price and some are missing."""
    before = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    part = F.col("o_orderkey") % 500
    price = F.when(part == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    after = before.where(F.coalesce(part != 8, F.lit(True))).withColumn("o_totalprice", price)
    return C.changed_rows(before, after, ["o_orderkey"])


def _longest_rise(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The longest run of events with rising values, carried over from batch to batch."""
    best = run = n = 0
    last = None
    for pdf in batches:
        for value in pdf["value"]:
            run = run + 1 if last is not None and value > last else 1
            best, last, n = max(best, run), value, n + 1
    yield pd.DataFrame({"user_id": pd.array([key[0]], "Int64"), "n": [n], "longest": [best]})


@query(
    "pandas_stream",
    """WITH o AS (SELECT user_id, value, row_number() OVER w AS i, coalesce(value > lag(value) OVER w, false) AS up FROM events
       WHERE value IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST)),
       g AS (SELECT user_id, i, sum(CASE WHEN up THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY i) AS g FROM o),
       r AS (SELECT user_id, g, count(*) AS n FROM g GROUP BY ALL)
       SELECT user_id, CAST(sum(n) AS BIGINT) AS n, max(n) AS longest FROM r GROUP BY user_id""",
)
def pandas_stream(spark, sf_dir):
    """Longest rise of values per user, each user's events read as a stream in time order."""
    events = load(spark, sf_dir, "events").where("value IS NOT NULL").select("user_id", "ts", "event_id", "value")
    return P.stream_groups(events, ["user_id"], _longest_rise, "user_id long, n long, longest long", order=["ts", "event_id"])
