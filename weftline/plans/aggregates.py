"""Aggregation queries, skew reports and skew-safe aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.functions.scalars import money, net_price, quantity_sum, total
from weftline.operators import aggregates as A, skew as S
from weftline.plans.registry import query
from weftline.sources.tables import load

QTY = "CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty"


@query("agg_sum", f"SELECT l_returnflag, {QTY} FROM lineitem GROUP BY l_returnflag")
def agg_sum(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(quantity_sum().alias("qty"))


@query("agg_sum_count", f"SELECT l_suppkey, {QTY}, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def agg_sum_count(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(quantity_sum().alias("qty"), F.count("*").alias("n"))


@query("agg_count", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def agg_count(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))


@query(
    "agg_global",
    f"""SELECT count(*) AS n, {QTY}, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS price,
        min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem""",
)
def agg_global(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").agg(
        F.count("*").alias("n"),
        quantity_sum().alias("qty"),
        total(money("l_extendedprice")).alias("price"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query(
    "agg_multi_key",
    f"""SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS year, {QTY}, count(*) AS n,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue
        FROM lineitem GROUP BY l_returnflag, l_linestatus, year(l_shipdate)""",
)
def agg_multi_key(spark, sf_dir):
    by = ["l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year")]
    return load(spark, sf_dir, "lineitem").groupBy(*by).agg(
        quantity_sum().alias("qty"), F.count("*").alias("n"), total(net_price()).alias("revenue")
    )


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()


FLAG_SQL = """SELECT l_returnflag || '_' || l_linestatus AS key, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
    count(*) AS n, min(l_quantity) AS smallest, max(l_quantity) AS largest,
    CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / count(l_quantity) AS mean FROM lineitem GROUP BY 1"""
FLAG_AGGS = {
    "qty": ("sum", "units"),
    "n": ("count", "*"),
    "smallest": ("min", "l_quantity"),
    "largest": ("max", "l_quantity"),
    "mean": ("avg", "units"),
}


def _flagged(spark, sf_dir) -> DataFrame:
    """Lines by a key that itself contains an underscore, with a stable row id for salting."""
    return load(spark, sf_dir, "lineitem", row_id="row").select(
        F.concat("l_returnflag", F.lit("_"), "l_linestatus").alias("key"),
        "l_quantity",
        F.col("l_quantity").cast("long").alias("units"),
        "row",
    )


@query("agg_two_phase", FLAG_SQL)
def agg_two_phase(spark, sf_dir):
    return S.salted_agg(_flagged(spark, sf_dir), ["key"], 16, FLAG_AGGS, salt_by=["row"])


@query("agg_split_skew", FLAG_SQL)
def agg_split_skew(spark, sf_dir):
    lines = _flagged(spark, sf_dir)
    hot = S.hot_predicate(lines, "key", share=0.16)
    return S.split_skew_agg(lines, ["key"], hot, 16, FLAG_AGGS, salt_by=["row"])


@query(
    "key_skew_report",
    """WITH c AS (SELECT l_returnflag || '_' || l_linestatus AS key, count(*) AS n FROM lineitem GROUP BY 1),
       t AS (SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS keys FROM c)
       SELECT key, n, n / total AS share, n * keys / total AS ratio, n / total > 0.5 AS dominant
       FROM c, t ORDER BY n DESC, key LIMIT 5""",
)
def key_skew_report(spark, sf_dir):
    return S.key_skew(_flagged(spark, sf_dir), ["key"], 5)


@query(
    "hot_keys",
    """WITH c AS (SELECT l_returnflag || '_' || l_linestatus AS key, count(*) AS n FROM lineitem GROUP BY 1)
       SELECT key, n FROM c WHERE n > (SELECT sum(n) FROM c) * CAST(0.16 AS DOUBLE)""",
)
def hot_keys(spark, sf_dir):
    return S.hot_keys(_flagged(spark, sf_dir), ["key"], 0.16)


@query("partition_skew_report", "SELECT count(*) AS rows, true AS consistent FROM lineitem")
def partition_skew_report(spark, sf_dir):
    """Rows per partition after a real shuffle by the flag key."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shuffled = _flagged(spark, sf_dir).repartition(partitions, "key")
    report = S.partition_skew(S.partition_sizes(shuffled, partitions))
    bounds = (F.col("min_rows") * F.col("partitions") <= F.col("rows")) & (F.col("rows") <= F.col("max_rows") * F.col("partitions"))
    return report.select("rows", (bounds & (F.col("empty") < F.col("partitions"))).alias("consistent"))


@query("partition_report")
def partition_report(spark, sf_dir):
    """The report itself: smallest, largest and mean partition after a shuffle by the flag key. Where keys go is Spark's own affair, so no SQL."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return S.partition_skew(S.partition_sizes(_flagged(spark, sf_dir).repartition(partitions, "key"), partitions))


@query("repartition_salted", "SELECT l_returnflag || '_' || l_linestatus AS key, l_quantity FROM lineitem")
def repartition_salted(spark, sf_dir):
    lines = _flagged(spark, sf_dir)
    hot = S.hot_predicate(lines, "key", share=0.05)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = S.salted_repartition(lines, ["key"], hot, partitions, salts=partitions, by=["row"])
    return spread.select("key", "l_quantity")


@query(
    "agg_rollup",
    f"""SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag, l_linestatus) AS INTEGER) AS grouping_id, {QTY}, count(*) AS n
        FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
)
def agg_rollup(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(
        F.grouping_id().cast("int").alias("grouping_id"), quantity_sum().alias("qty"), F.count("*").alias("n")
    )


@query(
    "agg_cube",
    f"""SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag, l_linestatus) AS INTEGER) AS grouping_id, {QTY}, count(*) AS n
        FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
)
def agg_cube(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(
        F.grouping_id().cast("int").alias("grouping_id"), quantity_sum().alias("qty"), F.count("*").alias("n")
    )


@query(
    "agg_grouping_sets",
    f"""SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag, l_linestatus) AS INTEGER) AS grouping_id, {QTY}
        FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus))""",
)
def agg_grouping_sets(spark, sf_dir):
    keys = ["l_returnflag", "l_linestatus"]
    return A.grouping_sets(load(spark, sf_dir, "lineitem"), [keys[:1], keys[1:]], keys, quantity_sum().alias("qty"))


@query(
    "agg_distinct",
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers
       FROM lineitem GROUP BY l_returnflag""",
)
def agg_distinct(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers")
    )


@query(
    "agg_conditional",
    """SELECT l_linestatus, CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS returned,
       count(CASE WHEN l_discount > 0.05 THEN 1 END) AS discounted FROM lineitem GROUP BY l_linestatus""",
)
def agg_conditional(spark, sf_dir):
    units = F.col("l_quantity").cast("long")
    return load(spark, sf_dir, "lineitem").groupBy("l_linestatus").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", units).otherwise(0)).alias("returned"),
        F.count(F.when(F.col("l_discount") > 0.05, 1)).alias("discounted"),
    )


@query(
    "agg_percentile",
    """SELECT l_returnflag, quantile_cont(l_quantity, 0.5) AS median, quantile_cont(l_quantity, 0.25) AS lower
       FROM lineitem GROUP BY l_returnflag""",
)
def agg_percentile(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    return A.exact_percentiles(lines, ["l_returnflag"], "l_quantity", {"median": 0.5, "lower": 0.25})


@query(
    "agg_approx_distinct",
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS exact, count(DISTINCT l_partkey) AS within
       FROM lineitem GROUP BY l_returnflag""",
)
def agg_approx_distinct(spark, sf_dir):
    """Exact distinct counts, and the estimate moved to the exact count if it is within five standard errors of it."""
    error = 0.02
    counted = load(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.approx_count_distinct("l_partkey", error).alias("estimate"), F.count_distinct("l_partkey").alias("exact")
    )
    close = F.abs(F.col("estimate") - F.col("exact")) <= F.col("exact") * (5 * error)
    return counted.select("l_returnflag", "exact", F.when(close, F.col("exact")).otherwise(F.col("estimate")).alias("within"))


# The event types of the event table.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "pivot",
    "SELECT CAST(ts AS DATE) AS day, "
    + ", ".join(f"count(CASE WHEN event_type = '{t}' THEN 1 END) AS {t}" for t in EVENT_TYPES)
    + ", count(*) - "
    + " - ".join(f"count(CASE WHEN event_type = '{t}' THEN 1 END)" for t in EVENT_TYPES)
    + " AS other FROM events GROUP BY 1",
)
def pivot(spark, sf_dir):
    known = F.when(F.col("event_type").isin(EVENT_TYPES), F.col("event_type")).otherwise("other")
    events = load(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), known.alias("event_type"))
    columns = [*EVENT_TYPES, "other"]
    return A.pivot_sum(events, ["day"], "event_type", columns, F.count(F.lit(1))).na.fill(0, columns)


@query(
    "unpivot",
    """SELECT c_custkey, 'c_acctbal' AS attribute, c_acctbal AS amount FROM customer
       UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS DOUBLE) FROM customer""",
)
def unpivot(spark, sf_dir):
    customers = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("c_nationkey")
    )
    return A.unpivot(customers, ["c_custkey"], ["c_acctbal", "c_nationkey"], "attribute", "amount")


@query(
    "flagship",
    """SELECT o_orderpriority, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE)
       AS revenue, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey
       WHERE o_orderstatus = 'F' AND l_returnflag = 'R' GROUP BY o_orderpriority ORDER BY revenue DESC""",
)
def flagship(spark, sf_dir):
    """Filter both sides, join, group and sort."""
    orders = load(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderpriority")
    lines = load(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    by_priority = joined.groupBy("o_orderpriority").agg(total(net_price()).alias("revenue"), F.count("*").alias("n"))
    return by_priority.orderBy(F.desc("revenue"), "o_orderpriority")
