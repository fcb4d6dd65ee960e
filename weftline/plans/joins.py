"""Join queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.functions.scalars import money, net_price, quantity_sum, total
from weftline.operators import joins as J, skew as S
from weftline.operators.reduction import Edge, reduced_join
from weftline.plans.registry import query
from weftline.plans.shared import orders_by_month
from weftline.session import scratch_table
from weftline.sources.catalog import bucketed_join, buckets_for, write_join_pair
from weftline.sources.tables import load

STATUS_SQL = """SELECT o_orderstatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, count(*) AS n
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderstatus"""


def _orders(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus")


def _lines(spark, sf_dir, row_id: str | None = None) -> DataFrame:
    kept = ["l_quantity"] + ([row_id] if row_id else [])
    return load(spark, sf_dir, "lineitem", row_id).select(F.col("l_orderkey").alias("orderkey"), *kept)


def _by_status(joined: DataFrame) -> DataFrame:
    return joined.groupBy("o_orderstatus").agg(quantity_sum().alias("qty"), F.count("*").alias("n"))


@query("join_inner", STATUS_SQL)
def join_inner(spark, sf_dir):
    return _by_status(_lines(spark, sf_dir).join(_orders(spark, sf_dir), "orderkey"))


@query("join_inner_expr", STATUS_SQL)
def join_inner_expr(spark, sf_dir):
    lines, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    return _by_status(lines.join(orders, lines.l_orderkey == orders.o_orderkey))


@query("join_broadcast", STATUS_SQL)
def join_broadcast(spark, sf_dir):
    return _by_status(J.broadcast_join(_lines(spark, sf_dir), _orders(spark, sf_dir), ["orderkey"]))


@query("join_shuffle_hash", STATUS_SQL)
def join_shuffle_hash(spark, sf_dir):
    return _by_status(J.shuffle_hash_join(_lines(spark, sf_dir), _orders(spark, sf_dir), ["orderkey"]))


@query("join_sort_merge", STATUS_SQL)
def join_sort_merge(spark, sf_dir):
    return _by_status(J.sort_merge_join(_lines(spark, sf_dir), _orders(spark, sf_dir), ["orderkey"]))


@query("join_skew_aqe", STATUS_SQL)
def join_skew_aqe(spark, sf_dir):
    """Left to adaptive execution: a sort-merge join whose oversized partitions are split at run time."""
    return _by_status(J.sort_merge_join(_lines(spark, sf_dir), _orders(spark, sf_dir), ["orderkey"]))


@query("join_salted", STATUS_SQL)
def join_salted(spark, sf_dir):
    lines = _lines(spark, sf_dir, row_id="row")
    # As many salts as the largest key needs.
    salts = S.salts_for(S.hot_counts(lines, ["orderkey"]), S.hot_rows(spark))
    return _by_status(S.salted_join(lines, _orders(spark, sf_dir), ["orderkey"], salts, salt_by=["row"]))


@query("join_split_skew", STATUS_SQL)
def join_split_skew(spark, sf_dir):
    lines = _lines(spark, sf_dir, row_id="row")
    hot = S.hot_counts(lines, ["orderkey"])
    is_hot, salts = S.in_groups(["orderkey"], list(hot)), S.salts_for(hot, S.hot_rows(spark))
    return _by_status(S.split_skew_join(lines, _orders(spark, sf_dir), ["orderkey"], is_hot, salts, salt_by=["row"]))


@query("bucket_join", STATUS_SQL)
def bucket_join(spark, sf_dir):
    tables = (scratch_table(spark, "lines"), scratch_table(spark, "orders"))
    lines = _lines(spark, sf_dir, row_id="row")
    write_join_pair(lines, _orders(spark, sf_dir), "orderkey", tables, buckets_for(lines), "row")
    return _by_status(bucketed_join(spark, tables, "orderkey"))


def _bulk_lines(spark, sf_dir) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem", row_id="row").where(F.col("l_quantity") >= 45)
    return lines.select(F.col("l_orderkey").alias("orderkey"), "l_partkey", "l_linenumber", "l_quantity", "row")


def _finished(spark, sf_dir) -> DataFrame:
    return _orders(spark, sf_dir).where(F.col("o_orderstatus") == "F")


@query(
    "join_left",
    """SELECT o_orderkey AS orderkey, o_orderstatus, l_partkey, l_linenumber, l_quantity
       FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity >= 45) ON o_orderkey = l_orderkey""",
)
def join_left(spark, sf_dir):
    return S.outer_join(_orders(spark, sf_dir), _bulk_lines(spark, sf_dir), ["orderkey"], "left", ["row"]).drop("row")


@query(
    "join_right",
    """SELECT l_orderkey AS orderkey, o_orderstatus, l_partkey, l_linenumber, l_quantity
       FROM (SELECT * FROM orders WHERE o_orderstatus = 'F')
       RIGHT JOIN (SELECT * FROM lineitem WHERE l_quantity >= 45) ON o_orderkey = l_orderkey""",
)
def join_right(spark, sf_dir):
    return S.outer_join(_finished(spark, sf_dir), _bulk_lines(spark, sf_dir), ["orderkey"], "right").drop("row")


@query(
    "join_full",
    """SELECT coalesce(o_orderkey, l_orderkey) AS orderkey, o_orderstatus, l_partkey, l_linenumber, l_quantity
       FROM (SELECT * FROM orders WHERE o_orderstatus = 'F')
       FULL JOIN (SELECT * FROM lineitem WHERE l_quantity >= 45) ON o_orderkey = l_orderkey""",
)
def join_full(spark, sf_dir):
    return S.outer_join(_finished(spark, sf_dir), _bulk_lines(spark, sf_dir), ["orderkey"], "full", ["row"]).drop("row")


@query(
    "join_semi",
    "SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 45)",
)
def join_semi(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").where(F.col("l_quantity") >= 45)
    return J.semi_join(load(spark, sf_dir, "orders"), lines.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])


@query(
    "join_anti",
    "SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_quantity >= 45 AND l_orderkey = o_orderkey)",
)
def join_anti(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").where(F.col("l_quantity") >= 45)
    return J.anti_join(load(spark, sf_dir, "orders"), lines.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])


@query(
    "not_in_null",
    """SELECT 'plain' AS keys, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 45)
       UNION ALL SELECT 'with_null', count(*) FROM orders WHERE o_orderkey NOT IN
       (SELECT CASE WHEN l_quantity < 50 THEN l_orderkey END FROM lineitem WHERE l_quantity >= 45)
       UNION ALL SELECT 'anti_with_null', count(*) FROM orders WHERE NOT EXISTS
       (SELECT 1 FROM lineitem WHERE l_quantity >= 45 AND l_quantity < 50 AND l_orderkey = o_orderkey)""",
)
def not_in_null(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    lines = load(spark, sf_dir, "lineitem").where(F.col("l_quantity") >= 45)
    plain = lines.select(F.col("l_orderkey").alias("o_orderkey"))
    holed = lines.select(F.when(F.col("l_quantity") < 50, F.col("l_orderkey")).alias("o_orderkey"))
    cases = {
        "plain": J.not_in(orders, plain, "o_orderkey"),
        "with_null": J.not_in(orders, holed, "o_orderkey"),
        "anti_with_null": J.anti_join(orders, holed, ["o_orderkey"]),
    }
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("keys"), "n") for name, df in cases.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query(
    "join_theta",
    """SELECT n_name, count(*) AS parts, CAST(sum(CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) AS price
       FROM part JOIN nation ON p_size < n_nationkey GROUP BY n_name""",
)
def join_theta(spark, sf_dir):
    # Parts are summed per size first: the nested loop then meets one row per size.
    sizes = load(spark, sf_dir, "part").groupBy("p_size").agg(
        F.count("*").alias("parts"), F.sum(money("p_retailprice")).alias("price")
    )
    pairs = J.theta_join(sizes, load(spark, sf_dir, "nation"), F.col("p_size") < F.col("n_nationkey"))
    return pairs.groupBy("n_name").agg(F.sum("parts").alias("parts"), total(F.col("price")).alias("price"))


@query(
    "join_range",
    """SELECT n_name AS band, event_id, value FROM events
       JOIN nation ON value >= n_nationkey * 4 AND value < n_nationkey * 4 + 6""",
)
def join_range(spark, sf_dir):
    start = (F.col("n_nationkey") * 4).cast("double")
    bands = load(spark, sf_dir, "nation").select(F.col("n_name").alias("band"), start.alias("lo"), (start + 6).alias("hi"))
    events = load(spark, sf_dir, "events").select("event_id", "value")
    return J.range_join(events, bands, "value", "lo", "hi", width=6.0).select("band", "event_id", "value")


@query(
    "join_asof_window",
    """SELECT p.event_id, p.user_id, p.ts, v.event_id AS view_id, v.value AS view_value
       FROM (SELECT * FROM events WHERE event_type = 'purchase') p
       ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def join_asof_window(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    purchases = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    views = events.where(F.col("event_type") == "view")
    return J.asof_last(purchases, views, "user_id", "ts", {"event_id": "view_id", "value": "view_value"})


@query(
    "join_cross",
    """SELECT r_name, c_mktsegment, count(*) AS n FROM customer CROSS JOIN region GROUP BY r_name, c_mktsegment""",
)
def join_cross(spark, sf_dir):
    pairs = J.product(load(spark, sf_dir, "customer").select("c_mktsegment"), load(spark, sf_dir, "region"))
    return pairs.groupBy("r_name", "c_mktsegment").agg(F.count("*").alias("n"))


REGION_SQL = """SELECT r_name, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue, count(*) AS n
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, year(o_orderdate)"""


def _by_region(joined: DataFrame) -> DataFrame:
    by = [F.col("r_name"), F.year("o_orderdate").alias("year")]
    return joined.groupBy(*by).agg(total(net_price()).alias("revenue"), F.count("*").alias("n"))


@query("join_chain", REGION_SQL)
def join_chain(spark, sf_dir):
    lines, orders, customer, nation, region = (
        load(spark, sf_dir, name) for name in ("lineitem", "orders", "customer", "nation", "region")
    )
    # From the smallest table to the largest, which is shuffled once.
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    buyers = customer.join(places, customer.c_nationkey == places.n_nationkey).select("c_custkey", "r_name")
    placed = orders.join(buyers, orders.o_custkey == buyers.c_custkey).select("o_orderkey", "o_orderdate", "r_name")
    return _by_region(lines.join(placed, lines.l_orderkey == placed.o_orderkey))


@query(
    "join_reduced",
    """SELECT n_name, o_orderpriority,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue, count(*) AS n
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name = 'ASIA' AND c_mktsegment = 'BUILDING' AND o_orderstatus = 'F' GROUP BY n_name, o_orderpriority""",
)
def join_reduced(spark, sf_dir):
    """Filters on far tables reach the line items as key filters, before these are shuffled."""
    read = lambda name, *columns: load(spark, sf_dir, name).select(*columns)
    tables = {
        "lineitem": read("lineitem", "l_orderkey", "l_extendedprice", "l_discount"),
        "orders": load(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderpriority"),
        "customer": load(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_nationkey"),
        "nation": read("nation", "n_nationkey", "n_name", "n_regionkey"),
        "region": load(spark, sf_dir, "region").where("r_name = 'ASIA'").select("r_regionkey"),
    }
    edges = [
        Edge("lineitem", "orders", [("l_orderkey", "o_orderkey")]),
        Edge("orders", "customer", [("o_custkey", "c_custkey")]),
        Edge("customer", "nation", [("c_nationkey", "n_nationkey")]),
        Edge("nation", "region", [("n_regionkey", "r_regionkey")]),
    ]
    joined = reduced_join(tables, edges, "lineitem")
    return joined.groupBy("n_name", "o_orderpriority").agg(total(net_price()).alias("revenue"), F.count("*").alias("n"))


@query("join_star", REGION_SQL.replace("GROUP BY", "WHERE l_quantity > 0 GROUP BY"))
def join_star(spark, sf_dir):
    # The widest tables carry only the columns the result needs.
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    dims = [
        (orders, "l_orderkey", "o_orderkey"),
        (customer, "o_custkey", "c_custkey"),
        (load(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey"),
        (load(spark, sf_dir, "region"), "n_regionkey", "r_regionkey"),
    ]
    return _by_region(J.star_join(load(spark, sf_dir, "lineitem"), dims, keep=F.col("l_quantity") > 0))


PRIORITY_SQL = """SELECT o_orderpriority, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, count(*) AS n
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' AND l_returnflag = 'R' GROUP BY o_orderpriority"""


@query("join_prefilter", PRIORITY_SQL)
def join_prefilter(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    lines = load(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.groupBy("o_orderpriority").agg(quantity_sum().alias("qty"), F.count("*").alias("n"))


@query(
    "join_pruned",
    """SELECT p_brand, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""",
)
def join_pruned(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity")
    parts = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return lines.join(parts, "l_partkey").groupBy("p_brand").agg(quantity_sum().alias("qty"))


@query(
    "join_self",
    """SELECT a.event_id, a.user_id, a.event_type AS first_type, b.event_type AS next_type
       FROM events a JOIN events b ON a.user_id = b.user_id AND b.event_id = a.event_id + 1""",
)
def join_self(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    a = events.select("event_id", "user_id", F.col("event_type").alias("first_type"))
    b = events.select((F.col("event_id") - 1).alias("event_id"), "user_id", F.col("event_type").alias("next_type"))
    return a.join(b, ["event_id", "user_id"])


@query(
    "join_key_align",
    """SELECT c_custkey, n.n_name AS nation_name, m.n_regionkey AS regionkey FROM customer
       JOIN nation n ON CAST(c_nationkey AS BIGINT) = CAST(n.n_nationkey AS BIGINT)
       JOIN nation m ON lower(n.n_name) = lower(m.n_name)""",
)
def join_key_align(spark, sf_dir):
    nation = load(spark, sf_dir, "nation")
    by_key = nation.select(F.col("n_nationkey").cast("string").alias("nation"), F.upper("n_name").alias("name"))
    by_name = nation.select(F.lower("n_name").alias("name"), F.col("n_regionkey").alias("regionkey"))
    names = J.safe_join(nation.select("n_nationkey", F.col("n_name").alias("name")), by_name, ["name"], fold_case=True)
    keyed = J.safe_join(
        load(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation")),
        by_key.select("nation"),
        ["nation"],
        cast="bigint",
    )
    named = names.select(F.col("n_nationkey").alias("nation"), F.col("name").alias("nation_name"), "regionkey")
    return J.broadcast_join(keyed, named, ["nation"]).select("c_custkey", "nation_name", "regionkey")


@query(
    "join_nulls_match",
    """SELECT CASE WHEN c_custkey IS NOT NULL THEN c.k ELSE n.k END AS nation, c_custkey, n_name
       FROM (SELECT c_custkey, nullif(c_nationkey, 0) AS k FROM customer WHERE c_nationkey < 20) c
       FULL JOIN (SELECT n_name, nullif(n_nationkey, 0) AS k FROM nation) n ON c.k IS NOT DISTINCT FROM n.k""",
)
def join_nulls_match(spark, sf_dir):
    """Null keys meet, and nations without customers keep their key."""
    customers = load(spark, sf_dir, "customer").where(F.col("c_nationkey") < 20)
    left = customers.select("c_custkey", F.nullif(F.col("c_nationkey"), F.lit(0)).alias("nation"))
    right = load(spark, sf_dir, "nation").select("n_name", F.nullif(F.col("n_nationkey"), F.lit(0)).alias("nation"))
    return J.safe_join(left, right, ["nation"], how="full", nulls_match=True)


@query(
    "join_dpp",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS price FROM orders
       WHERE year(o_orderdate) IN (SELECT year(l_shipdate) FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01')
       AND month(o_orderdate) <= 6 GROUP BY year(o_orderdate), month(o_orderdate)""",
)
def join_dpp(spark, sf_dir):
    """The years wanted are known only at run time, and still only their directories are read."""
    fact = orders_by_month(spark, sf_dir).where(F.col("month") <= 6)
    late = load(spark, sf_dir, "lineitem").where(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    years = late.select(F.year("l_shipdate").alias("year")).distinct()
    # A list of distinct years is bounded by the calendar, whatever the size of the table.
    joined = fact.join(F.broadcast(years), "year")
    return joined.groupBy("year", "month").agg(F.count("*").alias("n"), total(money("o_totalprice")).alias("price"))
