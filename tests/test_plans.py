"""Plans: what reaches the scan, which joins and exchanges are used."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import rows
from weftline.plans import rows as R
from weftline.plans.inspect import executed, physical
from weftline.plans.shared import orders_by_month
from weftline.session import scratch
from weftline.sources import layout as L
from weftline.sources.tables import load

Q = entry.queries()


def files_read(spark, df) -> int:
    """Files the scan of an executed plan really opened."""
    df.collect()
    text = df.select("*", F.input_file_name().alias("_file")).select("_file").distinct().count()
    return text


def orders_by_size(spark, sf_dir):
    """Orders in directories by status and price band; the small table has 3 x 6 of them, with 1,500 rows in all."""
    path = scratch(spark, "orders-by-size")
    band = F.least(F.floor(F.col("o_totalprice") / 100_000), F.lit(5)).cast("int").alias("band")
    rows_ = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), band)
    L.write_partitioned(rows_, path, ["status", "band"])
    return path


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = physical(Q["filter_cmp"](spark, sf_dir))
    assert "GreaterThan(l_quantity,40.0)" in plan and "l_extendedprice" not in plan
    assert "GreaterThan(p_size,20)" in physical(Q["filter_const_fold"](spark, sf_dir))
    assert "EqualTo(o_orderstatus,F)" in physical(Q["sql_subquery_filter"](spark, sf_dir))
    pruned = physical(Q["join_pruned"](spark, sf_dir))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in pruned


def test_filter_before_or_after_join_is_one_plan(spark, sf_dir):
    orders, lines = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    late = lines.join(orders, lines.l_orderkey == orders.o_orderkey).where(
        (F.col("o_orderstatus") == "F") & (F.col("l_returnflag") == "R")
    )
    late = late.groupBy("o_orderpriority").agg(F.sum(F.col("l_quantity").cast("long")).alias("qty"), F.count("*").alias("n"))
    early = Q["join_prefilter"](spark, sf_dir)
    assert rows(early) == rows(late)
    for wanted in ("EqualTo(o_orderstatus,F)", "EqualTo(l_returnflag,R)"):
        assert wanted in physical(early) and wanted in physical(late)


def test_partition_pruning_counts(spark, sf_dir):
    table = spark.read.parquet(orders_by_size(spark, sf_dir))
    places = {(r["status"], r["band"]) for r in table.select("status", "band").distinct().collect()}
    counted = {
        "status = 'F'": lambda s, b: s == "F",
        "status = 'O' AND band = 1": lambda s, b: (s, b) == ("O", 1),
        "abs(band) = 2": lambda s, b: b == 2,
        "length(status) + band = 3": lambda s, b: b == 2,
        "status IN ('F', 'P') AND band > 2": lambda s, b: s in "FP" and b > 2,
    }
    for predicate, wanted in counted.items():
        kept = table.where(predicate)
        plan = executed(kept)
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
        assert files_read(spark, kept) == sum(wanted(*p) for p in places), predicate


def test_dynamic_pruning(spark, sf_dir):
    assert "dynamicpruning" in physical(Q["join_dpp"](spark, sf_dir))


def test_pruned_scan_lists_partition_filters(spark, sf_dir):
    plan = physical(orders_by_month(spark, sf_dir).where("year = 1998 AND month = 3"))
    assert "year#" in plan.split("PartitionFilters")[1].split("]")[0]


def test_bucketed_join_has_no_exchange(spark, sf_dir, conf):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    joined = Q["bucket_join"](spark, sf_dir)
    plan = executed(joined).split("Initial Plan")[0]
    below_join = plan[plan.index("SortMergeJoin") :]
    assert "Exchange" not in below_join


def test_topk_and_twin(spark, sf_dir):
    assert "TakeOrderedAndProject" in physical(Q["topk"](spark, sf_dir))
    orders = load(spark, sf_dir, "orders")
    assert rows(R.twin_sql(orders)) == rows(R.twin_frame(orders))


def test_flagship_is_codegen_and_pruned(spark, sf_dir):
    plan = executed(Q["flagship"](spark, sf_dir))
    assert "*(" in plan
    assert "l_shipdate" not in plan and "o_totalprice" not in plan


def test_no_single_task_window(spark, sf_dir):
    """A window without a partition would pull everything into one task."""
    for key in ("win_rank", "win_running", "win_share", "key_skew_report", "dq_anomaly", "scd2_build"):
        df = Q[key](spark, sf_dir)
        plan = physical(df)
        for line in plan.splitlines():
            if "Window" in line and "windowspecdefinition(" in line:
                spec = line.split("windowspecdefinition(")[1]
                assert not spec.split(",")[0].strip().endswith("ASC NULLS FIRST"), (key, line)


def test_sort_within_orders_each_partition(spark, sf_dir):
    df = Q["sort_within"](spark, sf_dir).withColumn("part", F.spark_partition_id())
    seen = {}
    for r in df.collect():
        at = (r["o_custkey"], r["o_orderkey"])
        assert seen.get(r["part"], at) <= at
        seen[r["part"]] = at
