"""Queries over partitioned, bucketed and rewritten tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from weftline.functions.scalars import money, total
from weftline.operators.hierarchy import walk
from weftline.plans.registry import query
from weftline.plans.shared import orders_by_month, with_month
from weftline.session import scratch, scratch_table
from weftline.sources import catalog as C, layout as L
from weftline.sources.tables import append, load, read_evolved, read_format, write

MONTHLY_SQL = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n,
    CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS price FROM orders GROUP BY year(o_orderdate), month(o_orderdate)"""
DATED = "CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month"


def _monthly(df: DataFrame) -> DataFrame:
    return df.groupBy("year", "month").agg(F.count("*").alias("n"), total(money("o_totalprice")).alias("price"))


@query("part_write_read", MONTHLY_SQL)
def part_write_read(spark, sf_dir):
    path = scratch(spark, "orders-parts")
    L.write_partitioned(with_month(load(spark, sf_dir, "orders")), path, ["year", "month"])
    return _monthly(spark.read.parquet(path))


def _pruned(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "o_totalprice", "year", "month")


@query(
    "prune_eq",
    f"SELECT o_orderkey, o_totalprice, {DATED} FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 3",
)
def prune_eq(spark, sf_dir):
    return _pruned(orders_by_month(spark, sf_dir).where((F.col("year") == 1998) & (F.col("month") == 3)))


@query(
    "prune_range",
    f"SELECT o_orderkey, o_totalprice, {DATED} FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1997 AND month(o_orderdate) > 6",
)
def prune_range(spark, sf_dir):
    return _pruned(orders_by_month(spark, sf_dir).where(F.col("year").between(1996, 1997) & (F.col("month") > 6)))


@query("prune_in", f"SELECT o_orderkey, o_totalprice, {DATED} FROM orders WHERE year(o_orderdate) IN (1995, 2001)")
def prune_in(spark, sf_dir):
    return _pruned(orders_by_month(spark, sf_dir).where(F.col("year").isin(1995, 2001)))


def _by_year(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


YEAR_COLUMNS = f"o_orderkey, o_orderstatus, {DATED}"


@query("overwrite_static", f"SELECT {YEAR_COLUMNS} FROM orders WHERE year(o_orderdate) = 2000")
def overwrite_static(spark, sf_dir):
    path, rows = scratch(spark, "static"), _by_year(load(spark, sf_dir, "orders"))
    L.write_partitioned(rows, path, ["year"])
    L.overwrite(rows.where(F.col("year") == 2000), path, ["year"], "static")
    return spark.read.parquet(path)


REPLACED = "CASE WHEN {} THEN 'replaced' ELSE o_orderstatus END AS o_orderstatus"


@query(
    "overwrite_dynamic",
    f"SELECT o_orderkey, {REPLACED.format('year(o_orderdate) = 2000')}, {DATED} FROM orders",
)
def overwrite_dynamic(spark, sf_dir):
    path, rows = scratch(spark, "dynamic"), _by_year(load(spark, sf_dir, "orders"))
    L.write_partitioned(rows, path, ["year"])
    fresh = rows.where(F.col("year") == 2000).withColumn("o_orderstatus", F.lit("replaced"))
    L.overwrite(fresh, path, ["year"], "dynamic")
    return spark.read.parquet(path)


@query(
    "overwrite_one_partition",
    f"SELECT o_orderkey, {REPLACED.format('year(o_orderdate) = 1999 AND month(o_orderdate) = 1')}, {DATED} FROM orders",
)
def overwrite_one_partition(spark, sf_dir):
    path, rows = scratch(spark, "one"), _by_year(load(spark, sf_dir, "orders"))
    L.write_partitioned(rows, path, ["year", "month"])
    L.overwrite_partition(rows.withColumn("o_orderstatus", F.lit("replaced")), path, {"year": 1999, "month": 1})
    return spark.read.parquet(path)


@query("append_batches", "SELECT * FROM orders")
def append_batches(spark, sf_dir):
    path, orders = scratch(spark, "appended"), load(spark, sf_dir, "orders")
    for batch in _batches(orders):
        append(batch, path)
    return spark.read.parquet(path)


def _batches(orders: DataFrame, n: int = 3) -> list[DataFrame]:
    """The rows in ``n`` batches by a hash, which every row has, null keys included."""
    return [orders.where(L.bucket(n, "o_orderkey") == i) for i in range(n)]


def _orders_table(spark, label: str) -> str:
    name = scratch_table(spark, label)
    columns = "o_orderkey BIGINT, o_orderpriority STRING, price DECIMAL(12,2), year INT, month INT"
    C.create_partitioned_table(spark, name, columns, ["year", "month"])
    return name


def _dated_orders(spark, sf_dir) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    # The columns are in another order than in the table on purpose.
    return orders.select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        "o_orderpriority",
        "o_orderkey",
    )


@query(
    "table_insert",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS price FROM orders GROUP BY year(o_orderdate), o_orderpriority""",
)
def table_insert(spark, sf_dir):
    name = _orders_table(spark, "inserted")
    C.insert_into(L.rebalance(_dated_orders(spark, sf_dir), "year", "month"), name)
    return spark.table(name).groupBy("year", "o_orderpriority").agg(F.count("*").alias("n"), total(F.col("price")).alias("price"))


@query(
    "table_insert_static_part",
    """SELECT o_orderkey, o_orderpriority, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
       CAST(1997 AS INTEGER) AS year, CAST(5 AS INTEGER) AS month FROM orders
       WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 5""",
)
def table_insert_static_part(spark, sf_dir):
    name = _orders_table(spark, "one_part")
    rows = _dated_orders(spark, sf_dir).where((F.col("year") == 1997) & (F.col("month") == 5)).drop("year", "month")
    C.insert_partition(rows, name, {"year": 1997, "month": 5})
    return spark.table(name).withColumn("price", F.col("price").cast("double"))


@query(
    "partition_admin",
    f"""SELECT DISTINCT {DATED} FROM orders WHERE year(o_orderdate) IS DISTINCT FROM 1995
        UNION ALL SELECT CAST(2050 AS INTEGER), CAST(1 AS INTEGER)""",
)
def partition_admin(spark, sf_dir):
    """Register what was written past the catalog, add an empty partition, drop a whole year."""
    path, name = scratch(spark, "admin"), scratch_table(spark, "admin")
    L.write_partitioned(_by_year(load(spark, sf_dir, "orders")), path, ["year", "month"])
    columns = "o_orderkey BIGINT, o_orderstatus STRING, year INT, month INT"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (year, month) LOCATION '{path}'")
    C.repair(spark, name)
    C.add_partition(spark, name, {"year": 2050, "month": 1})
    C.drop_partition(spark, name, {"year": 1995})
    return C.list_partitions(spark, name)


@query("partition_list", f"SELECT DISTINCT {DATED} FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) > 3")
def partition_list(spark, sf_dir):
    name = _orders_table(spark, "listed")
    C.insert_into(L.rebalance(_dated_orders(spark, sf_dir), "year", "month"), name)
    return C.list_partitions(spark, name, (F.col("year") == 1998) & (F.col("month") > 3))


@query(
    "bucket_in_partition",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey, count(*) AS n FROM orders GROUP BY year(o_orderdate), o_custkey""",
)
def bucket_in_partition(spark, sf_dir):
    name = scratch_table(spark, "bucketed")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    C.write_bucketed(orders, name, 8, ["o_custkey"], partition_by=["year"])
    return spark.table(name).groupBy("year", "o_custkey").agg(F.count("*").alias("n"))


@query("transform_partition", "SELECT * FROM orders WHERE year(o_orderdate) = 1998")
def transform_partition(spark, sf_dir):
    path = scratch(spark, "transformed")
    derived = {"by_year": L.years("o_orderdate"), "by_key": L.bucket(16, "o_custkey")}
    L.write_transform_partitioned(load(spark, sf_dir, "orders"), path, derived)
    return L.read_transform_partitioned(spark, path, list(derived), where=F.col("by_year") == 1998)


@query("transform_month_day", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-03-11'")
def transform_month_day(spark, sf_dir):
    """Hidden partitions by month; a range of days prunes the months and is then checked by day."""
    path = scratch(spark, "transformed")
    L.write_transform_partitioned(load(spark, sf_dir, "orders"), path, {"by_month": L.months("o_orderdate")})
    month, day = F.col("by_month") == 1998 * 12 + 2, L.days("o_orderdate")
    wanted = month & day.between(F.lit("1998-03-01").cast("date"), F.lit("1998-03-10").cast("date"))
    return L.read_transform_partitioned(spark, path, ["by_month"], where=wanted)


def _fragmented(spark, sf_dir) -> str:
    """``orders`` by year, appended in many small pieces."""
    path, rows = scratch(spark, "fragments"), _by_year(load(spark, sf_dir, "orders"))
    for batch in _batches(rows):
        piece = batch.repartition(4)
        piece.write.mode("append").partitionBy("year").parquet(path)
    return path


@query("compact_files", f"SELECT {YEAR_COLUMNS} FROM orders")
def compact_files(spark, sf_dir):
    src, dst = _fragmented(spark, sf_dir), scratch(spark, "compacted")
    L.compact(spark, src, dst, ["year"])
    return spark.read.parquet(dst)


@query(
    "partition_health",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, true AS has_files, true AS all_small FROM orders GROUP BY 1",
)
def partition_health(spark, sf_dir):
    """Rows next to the file census of each partition, reduced to what SQL can state of files."""
    path = _fragmented(spark, sf_dir)
    census = L.file_census(spark, path, ["year"]).withColumnRenamed("year", "_year")
    counted = spark.read.parquet(path).groupBy("year").agg(F.count("*").alias("n"))
    joined = counted.join(census, F.col("year").eqNullSafe(F.col("_year")))
    return joined.select("year", "n", (F.col("files") >= 1).alias("has_files"), (F.col("small_files") == F.col("files")).alias("all_small"))


@query("repartition_rows", "SELECT * FROM orders")
def repartition_rows(spark, sf_dir):
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return load(spark, sf_dir, "orders").repartition(partitions, "o_orderkey")


@query("coalesce_rows", "SELECT * FROM orders")
def coalesce_rows(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    return orders.coalesce(max(1, spark.sparkContext.defaultParallelism // 2))


@query("rebalance_rows", "SELECT * FROM orders")
def rebalance_rows(spark, sf_dir):
    return L.rebalance(load(spark, sf_dir, "orders"), "o_custkey")


@query(
    "column_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max,
            CAST(count(*) - count({c}) AS VARCHAR) AS num_nulls, true AS distinct_close, true AS has_histogram FROM lineitem"""
        for c in ("l_orderkey", "l_partkey", "l_linenumber")
    ),
)
def column_stats(spark, sf_dir):
    name, columns = scratch_table(spark, "stats"), ["l_orderkey", "l_partkey", "l_linenumber"]
    load(spark, sf_dir, "lineitem").select(*columns).write.saveAsTable(name)
    stats = C.column_stats(spark, name, columns, histogram=True)
    exact = spark.table(name).agg(*[F.count_distinct(c).alias(c) for c in columns]).unpivot([], columns, "_name", "exact")
    close = F.abs(F.col("distinct_count").cast("double") / F.col("exact") - 1) <= 0.2
    joined = stats.join(exact, F.col("column_name") == F.col("_name"))
    return joined.select("column_name", "min", "max", "num_nulls", close.alias("distinct_close"), F.contains("histogram", F.lit("height")).alias("has_histogram"))


@query(
    "schema_evolution",
    """SELECT o_orderkey, o_totalprice, CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def schema_evolution(spark, sf_dir):
    old, new = scratch(spark, "generation"), scratch(spark, "generation")
    orders = load(spark, sf_dir, "orders")
    # Rows without a date are of the old generation.
    early = F.coalesce(F.year("o_orderdate") < 1998, F.lit(True))
    write(orders.where(early).select("o_orderkey", "o_totalprice"), old)
    write(orders.where(~early).select("o_orderkey", "o_totalprice", "o_orderpriority"), new)
    return read_evolved(spark, [old, new])


@query(
    "format_roundtrip",
    " UNION ALL ".join(
        f"SELECT '{f}' AS format, o_orderkey, o_orderdate, o_totalprice, o_orderpriority FROM orders" for f in ("orc", "json", "csv")
    ),
)
def format_roundtrip(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in orders.schema])
    read = []
    for fmt in ("orc", "json", "csv"):
        path = scratch(spark, fmt)
        write(orders, path, fmt=fmt)
        read.append(read_format(spark, path, fmt, schema).withColumn("format", F.lit(fmt)))
    return reduce(DataFrame.unionByName, read)


@query(
    "recursive_chain",
    """WITH RECURSIVE tree AS (SELECT CAST(0 AS BIGINT) AS node, 0 AS depth
       UNION ALL SELECT p_partkey, depth + 1 FROM part JOIN tree ON p_partkey // 2 = node WHERE p_partkey > 0)
       SELECT node, depth FROM tree""",
)
def recursive_chain(spark, sf_dir):
    """Every part has the part with half its number as parent."""
    parts = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"), F.expr("p_partkey div 2").alias("parent"))
    edges = parts.where(F.col("node") > 0)
    return walk(edges, parts.where(F.col("node") == 0))
