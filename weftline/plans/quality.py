"""Reuse, data quality, change capture, governance and pandas queries."""

from __future__ import annotations

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F, types as T

from weftline.functions.scalars import money, quantity_sum, total
from weftline.operators import changes as H, governance as G, pandas_groups as P, quality as Q
from weftline.operators.reuse import persisted, refresh
from weftline.plans.registry import query
from weftline.plans.shared import with_month
from weftline.session import materialise, scratch
from weftline.sources.layout import write_partitioned
from weftline.sources.tables import append, load, write

QTY = "CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty"


@query(
    "cached_multi_output",
    f"""SELECT 'flag' AS output, l_returnflag AS key, {QTY} FROM lineitem WHERE l_quantity >= 25 GROUP BY l_returnflag
        UNION ALL SELECT 'status', l_linestatus, {QTY} FROM lineitem WHERE l_quantity >= 25 GROUP BY l_linestatus""",
)
def cached_multi_output(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").where(F.col("l_quantity") >= 25)
    outputs = []
    with persisted(lines.select("l_returnflag", "l_linestatus", "l_quantity")) as base:
        for name, key in (("flag", "l_returnflag"), ("status", "l_linestatus")):
            grouped = base.groupBy(F.col(key).alias("key")).agg(quantity_sum().alias("qty"))
            outputs.append(materialise(grouped.select(F.lit(name).alias("output"), "key", "qty"), f"out-{name}"))
    return outputs[0].unionByName(outputs[1])


@query(
    "cached_iterations",
    f"SELECT l_linenumber AS iteration, l_returnflag AS key, {QTY} FROM lineitem GROUP BY l_linenumber, l_returnflag",
)
def cached_iterations(spark, sf_dir):
    """What a loop over iterations would compute one job at a time, in a single grouping."""
    lines = load(spark, sf_dir, "lineitem").select("l_linenumber", "l_returnflag", "l_quantity")
    by = [F.col("l_linenumber").alias("iteration"), F.col("l_returnflag").alias("key")]
    with persisted(lines) as base:
        return materialise(base.groupBy(*by).agg(quantity_sum().alias("qty")), "iterations")


@query(
    "cached_levels",
    f"""SELECT 'memory' AS level, l_returnflag AS key, {QTY} FROM lineitem GROUP BY l_returnflag
        UNION ALL SELECT 'disk', l_returnflag, {QTY} FROM lineitem GROUP BY l_returnflag""",
)
def cached_levels(spark, sf_dir):
    """The same base kept in memory and on disk: the level decides the place and not the result."""
    lines, outputs = load(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity"), []
    for name, level in (("memory", StorageLevel.MEMORY_ONLY), ("disk", StorageLevel.DISK_ONLY)):
        with persisted(lines, level) as base:
            grouped = base.groupBy(F.col("l_returnflag").alias("key")).agg(quantity_sum().alias("qty"))
            outputs.append(materialise(grouped.select(F.lit(name).alias("level"), "key", "qty"), f"level-{name}"))
    return outputs[0].unionByName(outputs[1])


@query("cache_refresh", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def cache_refresh(spark, sf_dir):
    path, orders = scratch(spark, "refreshed"), load(spark, sf_dir, "orders")
    early = F.coalesce(F.year("o_orderdate") < 1998, F.lit(False))
    write(orders.where(early), path)
    cached = spark.read.parquet(path).persist()
    cached.count()
    append(orders.where(~early), path)
    return refresh(spark, path, cached).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "dq_schema",
    """SELECT 'o_clerk' AS column_name, 'missing' AS problem, CAST(NULL AS BIGINT) AS rows
       UNION ALL SELECT 'o_orderpriority', 'unexpected', NULL UNION ALL SELECT 'o_orderkey', 'type', NULL
       UNION ALL SELECT 'o_totalprice', 'type', NULL
       UNION ALL SELECT 'o_totalprice', 'unparsable', count(*) FROM orders WHERE o_orderstatus = 'P'""",
)
def dq_schema(spark, sf_dir):
    price = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    raw = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), price.alias("o_totalprice"), "o_orderpriority"
    )
    contract = T.StructType().add("o_orderkey", "long").add("o_totalprice", "double").add("o_clerk", "string")
    return Q.check_schema(raw, contract)


def _profile_sql(table: str, columns: list[tuple[str, bool]]) -> str:
    parts = []
    for c, numeric in columns:
        mean = f"round(avg({c}), 6)" if numeric else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS ndv,
                CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, {mean} AS mean FROM {table}"""
        )
    return " UNION ALL ".join(parts)


@query(
    "dq_profile",
    _profile_sql(
        "customer",
        [("c_custkey", True), ("c_name", False), ("c_nationkey", True), ("c_acctbal", True), ("c_mktsegment", False)],
    ),
)
def dq_profile(spark, sf_dir):
    return Q.profile(load(spark, sf_dir, "customer"), exact=True).withColumn("mean", F.round("mean", 6))


@query(
    "dq_reconcile",
    """SELECT count(*) AS rows_a, count(CASE WHEN o_orderstatus <> 'F' THEN 1 END) AS rows_b,
       count(CASE WHEN o_orderstatus IS DISTINCT FROM 'O' THEN 1 END) AS only_a, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS only_b
       FROM orders""",
)
def dq_reconcile(spark, sf_dir):
    """A rewrite that lost one status and changed another."""
    before = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = F.when(F.col("o_orderstatus") == "P", "changed").otherwise(F.col("o_orderstatus"))
    after = before.where(F.col("o_orderstatus") != "F").withColumn("o_orderstatus", changed)
    return Q.reconcile(before, materialise(after, "rewritten"))


@query(
    "dq_rules",
    """SELECT 'key_present' AS rule, count(CASE WHEN l_orderkey IS NULL THEN 1 END) AS violations FROM lineitem
       UNION ALL SELECT 'small_quantity', count(CASE WHEN l_quantity < 1 OR l_quantity > 40 THEN 1 END) FROM lineitem
       UNION ALL SELECT 'line_unique', count(*) FROM
         (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
       UNION ALL SELECT 'finished_order', count(*) FROM lineitem
         WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey = l_orderkey)""",
)
def dq_rules(spark, sf_dir):
    finished = load(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    rules = {
        "key_present": Q.NotNull("l_orderkey"),
        "small_quantity": Q.InRange("l_quantity", 1, 40),
        "line_unique": Q.Unique(("l_orderkey", "l_linenumber")),
        "finished_order": Q.ForeignKey("l_orderkey", finished, "o_orderkey"),
    }
    return Q.check_rules(load(spark, sf_dir, "lineitem"), rules)


@query(
    "dq_anomaly",
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2),
       z AS (SELECT event_type, day, n, n - lag(n) OVER (PARTITION BY event_type ORDER BY day NULLS FIRST) AS change,
             (n - avg(n) OVER g) / nullif(stddev_samp(n) OVER g, 0) AS z FROM d WINDOW g AS (PARTITION BY event_type))
       SELECT event_type, day, n, change, round(z, 6) AS z, coalesce(abs(z) > 1.5, false) AS anomaly FROM z""",
)
def dq_anomaly(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    daily = events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return Q.anomalies(daily, ["event_type"], "day", "n", z=1.5).withColumn("z", F.round("z", 6))


@query(
    "null_handling",
    """SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE coalesce(value, 0) END AS value,
       CASE WHEN event_type = 'view' THEN 'unknown' ELSE event_type END AS event_type
       FROM events WHERE event_type <> 'signup' AND user_id IS NOT NULL""",
)
def null_handling(spark, sf_dir):
    kind = F.col("event_type")
    holed = load(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind != "signup", F.col("user_id")).alias("user_id"),
        F.when(kind != "error", F.col("value")).alias("value"),
        F.nullif(kind, F.lit("view")).alias("event_type"),
    )
    return Q.fill_nulls(Q.drop_nulls(holed, ["user_id"]), {"value": 0.0, "event_type": "unknown"})


CUTOFF = "2000-01-01"


def _is_early() -> Column:
    """Never null: rows without a date belong to the later ones. A row without a key takes no part in later changes."""
    return F.coalesce(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz"), F.lit(False)) | F.col("o_orderkey").isNull()


@query(
    "incremental_load",
    """SELECT o_orderkey, o_orderdate, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
)
def incremental_load(spark, sf_dir):
    """Order numbers rise as orders come in, their dates do not: the second load finds late rows in every old partition."""
    path = scratch(spark, "incremental")
    orders = with_month(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"))
    half = orders.agg(F.max("o_orderkey") / 2).scalar()
    write_partitioned(orders.where(F.col("o_orderkey") <= half), path, ["year", "month"])
    H.load_increment(orders, path, ["year", "month"], "o_orderkey")
    return spark.read.parquet(path)


def _base(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus").where(_is_early())


def _changes(spark, sf_dir) -> DataFrame:
    """Low priority orders are deleted, urgent ones updated twice, later ones inserted."""
    early, priority = _is_early(), F.col("o_orderpriority")

    def change(status: Column, op: str, version: int) -> Column:
        return F.struct(status.alias("o_orderstatus"), F.lit(op).alias("op"), F.lit(version).alias("version"))

    status = F.col("o_orderstatus")
    changes = (
        F.when(~early, F.array(change(status, "insert", 1)))
        .when(priority == "5-LOW", F.array(change(status, "delete", 1)))
        .when(priority == "1-URGENT", F.array(change(F.lit("first"), "update", 1), change(F.lit("second"), "update", 2)))
    )
    return load(spark, sf_dir, "orders").where("o_orderkey IS NOT NULL").select("o_orderkey", "o_orderdate", F.inline(changes))


CHANGED_SQL = """SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey IS NOT NULL AND o_orderdate < TIMESTAMP '2000-01-01' AND o_orderpriority = '1-URGENT'
    THEN 'second' ELSE o_orderstatus END AS o_orderstatus FROM orders
    WHERE o_orderkey IS NULL OR coalesce(o_orderdate >= TIMESTAMP '2000-01-01', true) OR o_orderpriority IS DISTINCT FROM '5-LOW'"""


@query("cdc_apply", CHANGED_SQL)
def cdc_apply(spark, sf_dir):
    return H.apply_cdc(_base(spark, sf_dir), _changes(spark, sf_dir), ["o_orderkey"], ["o_orderdate", "version"])


@query("merge_upsert", CHANGED_SQL)
def merge_upsert(spark, sf_dir):
    source = H.latest(_changes(spark, sf_dir), ["o_orderkey"], ["o_orderdate", "version"])
    return H.merge(_base(spark, sf_dir), source, ["o_orderkey"], ["o_orderstatus"], delete_when=F.col("op") == "delete")


HISTORY_SQL = """SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate AS valid_from,
    lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS valid_to FROM orders"""


def _history(spark, sf_dir) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return H.scd2(orders, ["o_custkey"], "o_orderdate", tie=["o_orderkey"])


@query("scd2_build", HISTORY_SQL)
def scd2_build(spark, sf_dir):
    return _history(spark, sf_dir)


@query(
    "asof_version",
    f"""SELECT * FROM ({HISTORY_SQL}) WHERE valid_from <= TIMESTAMP '1998-06-01'
        AND (valid_to IS NULL OR valid_to > TIMESTAMP '1998-06-01')""",
)
def asof_version(spark, sf_dir):
    return H.as_of(_history(spark, sf_dir), F.lit("1998-06-01").cast("timestamp_ntz"))


@query(
    "audit_rows",
    """SELECT CASE WHEN o_orderstatus IN ('F', 'O', 'P') THEN o_orderstatus ELSE 'other' END AS run, count(*) AS rows,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS price FROM orders GROUP BY 1""",
)
def audit_rows(spark, sf_dir):
    trail, orders = scratch(spark, "audit"), load(spark, sf_dir, "orders")
    run = F.when(F.col("o_orderstatus").isin("F", "O", "P"), F.col("o_orderstatus")).otherwise("other")
    for name in ("F", "O", "P", "other"):
        G.write_audited(orders.where(run == name), scratch(spark, "audited"), trail, name, price=total(money("o_totalprice")))
    return spark.read.parquet(trail).where("rows > 0")


@query("rls_filter", "SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')")
def rls_filter(spark, sf_dir):
    granted = [("ana", "BUILDING"), ("ana", "FURNITURE"), ("ben", "MACHINERY")]
    entitlements = spark.createDataFrame(granted, "user string, c_mktsegment string")
    return G.row_security(load(spark, sf_dir, "customer"), entitlements, "ana", "c_mktsegment")


@query(
    "mask_columns",
    """SELECT c_custkey, sha256(c_name) AS c_name, CAST(floor(c_acctbal / 1000) * 1000 AS BIGINT) AS c_acctbal,
       repeat('*', greatest(length(c_mktsegment) - 3, 0)) || right(c_mktsegment, 3) AS c_mktsegment FROM customer""",
)
def mask_columns(spark, sf_dir):
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return G.mask(customers, {"c_name": G.hashed, "c_acctbal": G.bucketed(1000), "c_mktsegment": G.partial(3)})


@query(
    "udf_lookup",
    "SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def udf_lookup(spark, sf_dir):
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    found = P.lookup(customers, load(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey", "n_name", "nation")
    return found.drop("c_nationkey")


@query("udf_vectorized", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def udf_vectorized(spark, sf_dir):
    net = P.vectorised(lambda price, discount: price * (1 - discount), "double", "l_extendedprice", "l_discount")
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", net.alias("net"))


@query(
    "udaf_custom",
    """SELECT l_suppkey, max(q) AS largest, max(CASE WHEN place = 2 THEN q END) AS second FROM
       (SELECT l_suppkey, l_quantity AS q, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS place FROM lineitem)
       GROUP BY l_suppkey""",
)
def udaf_custom(spark, sf_dir):
    return P.second_largest(load(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_quantity")


def _user_summary(pdf: pd.DataFrame) -> pd.DataFrame:
    cents = (pdf["value"] * 100).round().sum(min_count=1)
    return pd.DataFrame(
        {
            "user_id": pdf["user_id"].iloc[:1].to_numpy(),
            "n": [len(pdf)],
            "cents": pd.array([None if pd.isna(cents) else int(cents)], "Int64"),
            "first_event": [pdf["event_id"].min()],
            "last_event": [pdf["event_id"].max()],
        }
    )


def _merge_summaries(pdf: pd.DataFrame) -> pd.DataFrame:
    folds = {"n": "sum", "cents": lambda c: c.sum(min_count=1), "first_event": "min", "last_event": "max"}
    return pdf.groupby("user_id", as_index=False, dropna=False).agg(folds)


@query(
    "pandas_grouped",
    """SELECT user_id, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
       min(event_id) AS first_event, max(event_id) AS last_event FROM events GROUP BY user_id""",
)
def pandas_grouped(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "value")
    schema = "user_id long, n long, cents long, first_event long, last_event long"
    return P.per_group(events, ["user_id"], _user_summary, schema, merge=_merge_summaries, spread_by=["event_id"])


@query(
    "pandas_map",
    "SELECT event_id, upper(event_type) AS kind, value * 2 + 1 AS scaled FROM events WHERE value > 5",
)
def pandas_map(spark, sf_dir):
    def transform(batches):
        for pdf in batches:
            yield pd.DataFrame(
                {"event_id": pdf["event_id"], "kind": pdf["event_type"].str.upper(), "scaled": pdf["value"] * 2 + 1}
            )

    events = load(spark, sf_dir, "events").select("event_id", "event_type", "value").where(F.col("value") > 5)
    return events.mapInPandas(transform, "event_id long, kind string, scaled double")
