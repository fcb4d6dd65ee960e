"""Scans, projections, filters, scalar functions, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.functions.scalars import money, net_price, quantity_sum, total
from weftline.plans.registry import query
from weftline.session import scratch, scratch_table
from weftline.sources.tables import gen_range, load, query as sql_query, write


@query("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, sf_dir):
    return load(spark, sf_dir, "orders")


@query(
    "scan_range",
    """SELECT CAST(r.id AS BIGINT) AS id, count(o_orderkey) AS orders FROM
       (SELECT unnest(range(0, (SELECT max(c_custkey) + 1 FROM customer))) AS id) r LEFT JOIN orders ON o_custkey = r.id GROUP BY 1""",
)
def scan_range(spark, sf_dir):
    """Orders of every number up to the largest customer number, those without orders included."""
    numbers = gen_range(spark, load(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0] + 1)
    orders = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("o_orderkey").alias("orders"))
    return numbers.join(orders, "id", "left").select("id", F.coalesce("orders", F.lit(0)).alias("orders"))


@query("scan_table", "SELECT * FROM customer")
def scan_table(spark, sf_dir):
    name = scratch_table(spark, "customer")
    load(spark, sf_dir, "customer").write.saveAsTable(name)
    return spark.table(name)


@query(
    "sql_subquery_filter",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM (SELECT * FROM orders)
       WHERE o_orderstatus = 'F' AND o_totalprice > 250000""",
)
def sql_subquery_filter(spark, sf_dir):
    text = """SELECT o_orderkey, o_custkey, o_totalprice FROM (SELECT * FROM {orders})
              WHERE o_orderstatus = :status AND o_totalprice > :above"""
    return sql_query(spark, text, {"status": "F", "above": 250000}, orders=load(spark, sf_dir, "orders"))


@query("write_parquet", "SELECT * FROM part")
def write_parquet(spark, sf_dir):
    path = scratch(spark, "part")
    write(load(spark, sf_dir, "part"), path, mode="overwrite")
    return spark.read.parquet(path)


@query("project", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def project(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")


@query("filter_cmp", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 40")
def filter_cmp(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity").where(F.col("l_quantity") > 40)


@query("filter_eq", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").where(F.col("o_orderstatus") == "F")


@query(
    "filter_and",
    "SELECT l_orderkey, l_quantity, l_discount FROM lineitem WHERE l_returnflag = 'R' AND l_quantity < 10 AND l_discount >= 0.05",
)
def filter_and(spark, sf_dir):
    keep = (F.col("l_returnflag") == "R") & (F.col("l_quantity") < 10) & (F.col("l_discount") >= 0.05)
    return load(spark, sf_dir, "lineitem").where(keep).select("l_orderkey", "l_quantity", "l_discount")


@query("filter_in", "SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def filter_in(spark, sf_dir):
    return load(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))


@query("filter_not_in", "SELECT * FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def filter_not_in(spark, sf_dir):
    return load(spark, sf_dir, "customer").where(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))


@query("filter_between", "SELECT p_partkey, p_size, p_retailprice FROM part WHERE p_size BETWEEN 10 AND 20")
def filter_between(spark, sf_dir):
    return load(spark, sf_dir, "part").where(F.col("p_size").between(10, 20)).select("p_partkey", "p_size", "p_retailprice")


@query("filter_not_null", "SELECT event_id, user_id, value FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL")
def filter_not_null(spark, sf_dir):
    keep = F.col("value").isNotNull() & F.col("user_id").isNotNull()
    return load(spark, sf_dir, "events").where(keep).select("event_id", "user_id", "value")


@query("filter_const_fold", "SELECT p_partkey, p_size FROM part WHERE p_size > 18 + 2")
def filter_const_fold(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", "p_size").where(F.col("p_size") > F.lit(18) + F.lit(2))


@query("filter_unprojected", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'")
def filter_unprojected(spark, sf_dir):
    return load(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_totalprice")


@query(
    "derive_columns",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       o_orderkey % 1000 + 1 AS bucket FROM orders""",
)
def derive_columns(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    derived = {
        "year": F.year("o_orderdate"),
        "month": F.month("o_orderdate"),
        "bucket": F.col("o_orderkey") % 1000 + 1,
    }
    return orders.withColumns(derived).drop("o_orderdate")


@query("drop_columns", "SELECT s_suppkey, s_name FROM supplier")
def drop_columns(spark, sf_dir):
    return load(spark, sf_dir, "supplier").drop("s_nationkey", "s_acctbal")


@query(
    "case_when",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium'
       ELSE 'small' END AS size_class FROM orders""",
)
def case_when(spark, sf_dir):
    price = F.col("o_totalprice")
    size = F.when(price >= 300000, "large").when(price >= 100000, "medium").otherwise("small")
    return load(spark, sf_dir, "orders").select("o_orderkey", size.alias("size_class"))


@query(
    "transform_chain",
    """SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE)
       AS revenue FROM lineitem WHERE l_quantity >= 25 GROUP BY l_returnflag""",
)
def transform_chain(spark, sf_dir):
    def bulk(df: DataFrame) -> DataFrame:
        return df.where(F.col("l_quantity") >= 25)

    def priced(df: DataFrame) -> DataFrame:
        return df.withColumn("net", net_price())

    def by_flag(df: DataFrame) -> DataFrame:
        return df.groupBy("l_returnflag").agg(total(F.col("net")).alias("revenue"))

    return load(spark, sf_dir, "lineitem").transform(bulk).transform(priced).transform(by_flag)


@query(
    "cast_types",
    """SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_custkey AS VARCHAR) AS customer, CAST(o_orderdate AS DATE) AS day,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
       TRY_CAST(o_orderstatus AS INTEGER) AS not_a_number FROM orders""",
)
def cast_types(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_orderdate").cast("date").alias("day"),
        money("o_totalprice").cast("double").alias("price"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("level"),
        F.col("o_orderstatus").try_cast("int").alias("not_a_number"),
    )


@query(
    "fn_string",
    """SELECT p_partkey, p_brand || '_' || p_type AS label, split_part(p_name, ' ', 1) AS first_word,
       lower(p_type) AS type_lower FROM part""",
)
def fn_string(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat("p_brand", F.lit("_"), "p_type").alias("label"),
        F.split("p_name", " ").getItem(0).alias("first_word"),
        F.lower("p_type").alias("type_lower"),
    )


@query(
    "fn_date",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
       CAST(day(o_orderdate) AS INTEGER) AS d, to_timestamp(o_orderkey)::TIMESTAMP AS from_id FROM orders""",
)
def fn_date(spark, sf_dir):
    since_epoch = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("o_orderkey").cast("decimal(18,6)"))
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("y"),
        F.month("o_orderdate").alias("m"),
        F.dayofmonth("o_orderdate").alias("d"),
        since_epoch.alias("from_id"),
    )


@query(
    "fn_date_trunc",
    """SELECT event_id, date_trunc('year', ts)::TIMESTAMP AS y, date_trunc('month', ts)::TIMESTAMP AS m,
       date_trunc('day', ts)::TIMESTAMP AS d FROM events""",
)
def fn_date_trunc(spark, sf_dir):
    truncated = [F.date_trunc(unit, "ts").cast("timestamp_ntz").alias(unit[0]) for unit in ("year", "month", "day")]
    return load(spark, sf_dir, "events").select("event_id", *truncated)


@query(
    "fn_math",
    """SELECT l_orderkey, l_linenumber, l_partkey % 7 AS remainder, ((l_suppkey - 50) % 7 + 7) % 7 AS bucket,
       (l_suppkey - 50) % 7 AS signed_remainder, l_quantity * 2 + 1 AS scaled FROM lineitem""",
)
def fn_math(spark, sf_dir):
    shifted = F.col("l_suppkey") - 50
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_partkey") % 7).alias("remainder"),
        F.pmod(shifted, F.lit(7)).alias("bucket"),
        (shifted % 7).alias("signed_remainder"),
        (F.col("l_quantity") * 2 + 1).alias("scaled"),
    )


@query("fn_bucket", "SELECT o_custkey, count(*) AS n, CAST(1 AS BIGINT) AS buckets, true AS inside FROM orders GROUP BY o_custkey")
def fn_bucket(spark, sf_dir):
    """Every key is in one bucket of the sixteen."""
    from weftline.sources.layout import bucket

    bucketed = load(spark, sf_dir, "orders").select("o_custkey", bucket(16, "o_custkey").alias("bucket"))
    inside = F.bool_and(F.col("bucket").between(0, 15)).alias("inside")
    return bucketed.groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_distinct("bucket").alias("buckets"), inside)


@query(
    "fn_array_explode",
    """SELECT n_nationkey, word FROM (SELECT n_nationkey, unnest(['a_' || n_name, 'b_' || n_name]) AS word FROM nation)
       UNION ALL SELECT CAST(c_nationkey AS INTEGER), 'step_' || step FROM
       (SELECT c_nationkey, unnest(generate_series(0, c_nationkey)) AS step FROM customer)""",
)
def fn_array_explode(spark, sf_dir):
    nation = load(spark, sf_dir, "nation")
    words = F.array(*[F.concat(F.lit(p), "n_name") for p in ("a_", "b_")])
    named = nation.select("n_nationkey", F.explode(words).alias("word"))
    steps = load(spark, sf_dir, "customer").select("c_nationkey", F.explode(F.sequence(F.lit(0), "c_nationkey")).alias("step"))
    return named.unionAll(steps.select("c_nationkey", F.concat(F.lit("step_"), F.col("step").cast("string"))))


@query(
    "sort_global",
    """SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM lineitem GROUP BY l_suppkey
       ORDER BY qty DESC, l_suppkey""",
)
def sort_global(spark, sf_dir):
    by_supplier = load(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(quantity_sum().alias("qty"))
    return by_supplier.orderBy(F.desc("qty"), "l_suppkey")


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def topk(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    "sort_multi",
    "SELECT o_custkey, o_orderdate, o_orderkey FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey",
)
def sort_multi(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return orders.orderBy("o_custkey", F.desc("o_orderdate"), "o_orderkey")


@query("sort_within", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def sort_within(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return orders.sortWithinPartitions("o_custkey", "o_orderkey")


@query(
    "union_all",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
)
def union_all(spark, sf_dir):
    customers = load(spark, sf_dir, "customer").toDF("id", "name", "nation", "balance", "segment")
    suppliers = load(spark, sf_dir, "supplier").toDF("id", "name", "nation", "balance")
    return customers.select("id", "name", "balance").unionByName(suppliers.select("balance", "name", "id"))


@query("union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, sf_dir):
    # Each side is made distinct first, so the union moves only distinct values.
    customers = load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).distinct()
    suppliers = load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")).distinct()
    return customers.union(suppliers).distinct()


@query(
    "sql_df_twin",
    """SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS price
       FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY o_orderstatus""",
)
def sql_df_twin(spark, sf_dir):
    return twin_sql(load(spark, sf_dir, "orders"))


def twin_sql(orders: DataFrame) -> DataFrame:
    text = """SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS price
              FROM {orders} WHERE o_orderpriority = '2-HIGH' GROUP BY o_orderstatus"""
    return sql_query(orders.sparkSession, text, orders=orders)


def twin_frame(orders: DataFrame) -> DataFrame:
    kept = orders.where(F.col("o_orderpriority") == "2-HIGH")
    return kept.groupBy("o_orderstatus").agg(F.count("*").alias("n"), total(money("o_totalprice")).alias("price"))


@query(
    "sql_param",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' AND o_orderstatus = 'O'""",
)
def sql_param(spark, sf_dir):
    text = """SELECT o_orderkey, o_totalprice FROM {orders}
              WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) AND o_orderdate < CAST(:until AS TIMESTAMP_NTZ)
              AND o_orderstatus = :status"""
    args = {"since": "1998-01-01", "until": "1999-01-01", "status": "O"}
    return sql_query(spark, text, args, orders=load(spark, sf_dir, "orders"))


