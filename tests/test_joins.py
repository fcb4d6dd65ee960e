from __future__ import annotations

import pytest
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from weftline.operators import joins as J
from weftline.plans.inspect import executed

SLOW = settings(
    max_examples=6, deadline=None, derandomize=True, phases=[Phase.generate], suppress_health_check=list(HealthCheck)
)


def sides(spark):
    big = spark.range(10_000).select("id", (F.col("id") % 1000).alias("key"))
    return big, spark.range(1000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))


def test_strategies_agree_and_are_used(spark):
    big, small = sides(spark)
    plans = {
        "BroadcastHashJoin": J.broadcast_join(big, small, ["key"]),
        "ShuffledHashJoin": J.shuffle_hash_join(big, small, ["key"]),
        "SortMergeJoin": J.sort_merge_join(big, small, ["key"]),
    }
    results = []
    for name, df in plans.items():
        assert name in executed(df)
        results.append(rows(df))
    assert results[0] == results[1] == results[2] and len(results[0]) == 10_000


def test_large_side_is_not_broadcast(spark, conf):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    big, small = sides(spark)
    assert not J.fits(small, max_rows=999)
    assert not J.fits(small, max_bytes=100)
    assert J.fits(small)
    plan = executed(big.join(J.broadcast_if_small(small, max_rows=999), "key"))
    assert "Broadcast" not in plan


def test_not_in_and_anti_differ_on_null(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(J.anti_join(left, right, ["k"])) == [(2,), (None,)]
    assert rows(J.not_in(left, right, "k")) == []
    assert rows(J.not_in(left, right.where("k is not null"), "k")) == [(2,)]
    assert rows(J.not_in(left, right.limit(0), "k")) == rows(left)


def test_join_without_key_is_refused(spark):
    big, small = sides(spark)
    with pytest.raises(ValueError, match="at least one key"):
        J.safe_join(big, small, [])


def test_product_and_theta_of_any_size(spark):
    _, small = sides(spark)
    few = spark.range(130).withColumnRenamed("id", "n")
    assert J.product(small, few).count() == 130_000
    assert "CartesianProduct" not in executed(J.product(small, few))
    assert J.product(small, few.limit(0)).count() == 0
    assert rows(J.product(small, few, max_rows=100)) == rows(J.product(small, few))
    below = F.col("key") < F.col("n")
    tiled = J.theta_join(small, few, below, max_rows=100)
    assert rows(tiled) == rows(J.theta_join(small, few, below)) and tiled.columns == ["key", "v", "n"]
    assert "NestedLoop" not in executed(tiled)


def test_safe_join_aligns_keys(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y"), (None, "z")], "k string, a string")
    b = spark.createDataFrame([(1, "p"), (3, "q"), (None, "r")], "k int, b string")
    assert rows(J.safe_join(a, b, ["k"], cast="bigint"), "a", "b") == [("x", "p")]
    assert rows(J.safe_join(a, b, ["k"], cast="bigint", nulls_match=True), "a", "b") == [("x", "p"), ("z", "r")]
    full = J.safe_join(a, b, ["k"], how="full", cast="bigint")
    assert rows(full, "k", "a", "b") == sorted([("1", "x", "p"), ("2", "y", None), (None, "z", None), ("3", None, "q"), (None, None, "r")], key=repr)
    assert rows(J.safe_join(a, b, ["k"], how="right", cast="bigint"), "k", "b") == sorted([("1", "p"), ("3", "q"), (None, "r")], key=repr)
    c = spark.createDataFrame([("Peru",), ("peru",)], "name string")
    d = spark.createDataFrame([("PERU", 1)], "name string, n int")
    assert J.safe_join(c, d, ["name"], fold_case=True).count() == 2


VALUES = st.floats(-50, 50, allow_nan=False).map(lambda x: round(x, 1))


@SLOW
@given(st.lists(VALUES, max_size=40), st.lists(st.tuples(VALUES, st.sampled_from([-1.0, 0.0, 0.5, 3.0, 8.0, 300.0])), max_size=15))
def test_range_join_is_nested_loop(spark, values, starts):
    points = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double")
    bands = spark.createDataFrame([(i, lo, lo + n) for i, (lo, n) in enumerate(starts)], "band long, lo double, hi double")
    expected = [(i, b) for i, v in enumerate(values) for b, (lo, n) in enumerate(starts) if lo <= v < lo + n]
    assert rows(J.range_join(points, bands, "v", "lo", "hi", 2.5), "id", "band") == sorted(expected, key=repr)


def test_range_join_plan_has_no_nested_loop(spark, conf):
    points = spark.range(1000).select("id", F.col("id").cast("double").alias("v"))
    bands = spark.range(50).select(F.col("id").alias("band"), (F.col("id") * 10.0).alias("lo"), (F.col("id") * 10.0 + 15).alias("hi"))
    plan = executed(J.range_join(points, bands, "v", "lo", "hi", 15.0))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_open_bands(spark):
    inf = float("inf")
    points = spark.createDataFrame([(-1e30,), (0.5,), (7.0,)], "v double")
    bands = spark.createDataFrame([("up", 1.0, inf), ("down", -inf, 1.0), ("all", -inf, inf), ("one", 0.0, 1.0)], "band string, lo double, hi double")
    got = rows(J.range_join(points, bands, "v", "lo", "hi", 1.0), "v", "band")
    want = [(-1e30, "all"), (-1e30, "down"), (0.5, "all"), (0.5, "down"), (0.5, "one"), (7.0, "all"), (7.0, "up")]
    assert got == sorted(want, key=repr)


def test_asof_nulls_and_ties(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, None, 5), (3, "a", None), (4, "b", 1)], "id long, k string, t long")
    right = spark.createDataFrame([("a", 3, 1, 9), ("a", 3, 2, 8), (None, 1, 3, 7), ("b", None, 4, 6)], "k string, t long, v long, w long")
    got = J.asof_last(left, right, "k", "t", {"v": "found"}, tie=["w"])
    assert rows(got, "id", "found") == [(1, 1), (2, None), (3, None), (4, None)]
    assert rows(J.asof_last(left, right, "k", "t", {"v": "found"}), "id", "found")[0] == (1, 2)


def test_wide_band_touches_few_bins(spark):
    points = spark.createDataFrame([(0.5,), (123456.0,)], "v double")
    bands = spark.createDataFrame([(0.0, 1e12)], "lo double, hi double")
    assert J.range_join(points, bands, "v", "lo", "hi", 0.001).count() == 2
