from __future__ import annotations

import pytest
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tests.conftest import rows
from weftline.operators import joins as J, skew as S, windows as W
from weftline.plans.inspect import executed

# Keys with underscores, one dominant key, and null.
KEYS = st.sampled_from(["hot_key", "hot_key", "hot_key", "a_1", "a_2", "b", "", None])
SLOW = settings(
    max_examples=6, deadline=None, derandomize=True, phases=[Phase.generate], suppress_health_check=list(HealthCheck)
)


def readings(spark, n):
    """Every third row belongs to the busy sensor, the others to forty more."""
    sensor = F.when(F.col("id") % 3 == 0, "busy").otherwise(F.format_string("s%02d", F.col("id") % 40))
    return spark.range(n).select("id", sensor.alias("key"), (F.col("id") % 11).alias("amount"))


def sensors(spark):
    names = [("busy", 0)] + [(f"s{i:02d}", i) for i in range(50)]
    return spark.createDataFrame(names, "key string, room long")


def frame(spark, keys, value):
    data = [(i, k, i % 7) for i, k in enumerate(keys)]
    return spark.createDataFrame(data, f"id long, key string, {value} long")


def test_salted_join_is_plain_join(spark):
    a, b = readings(spark, 3_000), sensors(spark)
    assert rows(S.salted_join(a, b, ["key"], 10, salt_by=["id"])) == rows(a.join(b, "key"))


def test_null_keys_stay_in_one_half(spark):
    holed = readings(spark, 6_000).withColumn("key", F.when(F.col("id") % 97 > 0, F.col("key")))
    hot = S.hot_predicate(holed, "key", 0.05)
    summed = S.split_skew_agg(holed, ["key"], hot, 8, {"n": ("count", "*")}, ["id"])
    assert rows(summed) == rows(holed.groupBy("key").agg(F.count("*").alias("n")))
    joined = S.split_skew_join(holed, sensors(spark), ["key"], hot, 8, salt_by=["id"])
    assert joined.count() == holed.where("key IS NOT NULL").count()


def test_two_phase_sums(spark):
    aggs = {"total": ("sum", "amount"), "n": ("count", "*"), "lo": ("min", "amount"), "mean": ("avg", "amount")}
    found = {r["key"]: r for r in S.salted_agg(readings(spark, 3_300), ["key"], 10, aggs, ["id"]).collect()}
    busy = [i % 11 for i in range(0, 3_300, 3)]
    assert len(found) == 41
    assert tuple(found["busy"])[1:] == (sum(busy), len(busy), 0, sum(busy) / len(busy))


@SLOW
@given(st.lists(KEYS, max_size=60), st.lists(KEYS, max_size=25), st.integers(1, 5), st.sampled_from(["inner", "left", "right", "full"]))
def test_split_join_is_plain_join(spark, left, right, n, how):
    a, b = frame(spark, left, "x"), frame(spark, right, "y").drop("id")
    hot = S.in_groups(["key"], S.hot_groups(a, ["key"], max_rows=2))
    assert rows(S.split_skew_join(a, b, ["key"], hot, n, how, ["id"])) == rows(a.join(b, ["key"], how))


@SLOW
@given(st.lists(KEYS, max_size=25), st.lists(KEYS, max_size=60), st.sampled_from(["left", "right", "full"]))
def test_outer_join_is_plain_join(spark, left, right, how):
    a, b = frame(spark, left, "x").drop("id"), frame(spark, right, "y")
    assert rows(S.outer_join(a, b, ["key"], how, max_rows=2)) == rows(a.join(b, ["key"], how))


@SLOW
@given(st.lists(KEYS, max_size=60), st.integers(1, 6))
def test_salted_agg_is_plain_agg(spark, keys, n):
    df = frame(spark, keys, "x")
    aggs = {"s": ("sum", "x"), "n": ("count", "*"), "m": ("max", "x"), "a": ("avg", "x")}
    plain = df.groupBy("key").agg(F.sum("x").alias("s"), F.count("*").alias("n"), F.max("x").alias("m"), F.avg("x").alias("a"))
    assert rows(S.salted_agg(df, ["key"], n, aggs)) == rows(plain)
    hot = S.hot_predicate(df, "key", 0.2)
    assert rows(S.split_skew_agg(df, ["key"], hot, n, aggs)) == rows(plain)


ORDERED = st.lists(st.tuples(KEYS, st.one_of(st.none(), st.integers(-20, 20))), max_size=70)


def ordered(spark, pairs):
    return spark.createDataFrame([(i, k, t, i % 5) for i, (k, t) in enumerate(pairs)], "id long, key string, t long, v long")


@SLOW
@given(ORDERED, st.booleans())
def test_hot_rank_is_plain_rank(spark, pairs, desc):
    df = ordered(spark, pairs)
    cut = W.rank_in(df, ["key"], ["t"], ["id"], tiles=3, desc=desc, max_rows=4)
    plain = W.rank_in(df, ["key"], ["t"], ["id"], tiles=3, desc=desc, max_rows=10**9)
    assert rows(cut) == rows(plain)


@SLOW
@given(ORDERED, st.integers(1, 9))
def test_hot_frames_are_plain_frames(spark, pairs, n):
    df, value = ordered(spark, pairs), F.when(F.col("v") != 3, F.col("v"))
    for call in (
        lambda limit: W.shift_in(df, ["key"], ["t", "id"], "v", n, max_rows=limit),
        lambda limit: W.running(df, ["key"], ["t", "id"], value, "total", max_rows=limit),
        lambda limit: W.moving_rows(df, ["key"], ["t", "id"], value, "total", n, max_rows=limit),
    ):
        assert rows(call(4)) == rows(call(10**9))


@SLOW
@given(st.lists(st.tuples(KEYS, st.integers(0, 400)), max_size=70), st.integers(1, 120))
def test_hot_time_range_is_plain_range(spark, pairs, seconds):
    df = ordered(spark, pairs).withColumn("ts", F.timestamp_seconds("t"))
    cut = W.moving_range(df, ["key"], "ts", F.col("v"), "total", seconds, max_rows=4)
    assert rows(cut) == rows(W.moving_range(df, ["key"], "ts", F.col("v"), "total", seconds, max_rows=10**9))


@SLOW
@given(st.lists(st.tuples(KEYS, st.integers(0, 30)), max_size=40), st.lists(st.tuples(KEYS, st.integers(0, 30)), max_size=60))
def test_asof_is_brute_force(spark, left, right):
    a = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(left)], "id long, key string, t long")
    unique = {(k, t): i for i, (k, t) in enumerate(right)}
    b = spark.createDataFrame([(k, t, i) for (k, t), i in unique.items()], "key string, t long, v long")
    expected = []
    for i, (k, t) in enumerate(left):
        before = [(u, v) for (key, u), v in unique.items() if key == k and u <= t]
        expected.append((i, max(before)[1] if before else None))
    for limit in (4, 10**9):
        got = J.asof_last(a, b, "key", "t", {"v": "found"}, max_rows=limit)
        assert rows(got, "id", "found") == sorted(expected, key=repr)


def test_hot_groups_are_found_without_a_cap_or_single_task(spark):
    df = readings(spark, 3_000)
    assert S.hot_groups(df, ["key"], max_rows=500) == [spark.range(1).select(F.xxhash64(F.lit("busy"))).first()[0]]
    assert len(S.hot_groups(df, ["key"], max_rows=10)) == 41
    counted = df.groupBy(F.xxhash64("key").alias("h")).agg(F.count("*").alias("n"))
    assert "SinglePartition" not in executed(counted.where("n > 5"))


def test_hot_plan_has_no_window_over_the_whole_group(spark):
    plan = executed(W.running(readings(spark, 3_000), ["key"], ["id"], F.col("amount"), "total", max_rows=200))
    assert "Window" in plan and "_slice" in plan


@pytest.mark.parametrize("order", ["t", "text", "flag"])
def test_slices_are_even_whatever_the_order_values_are(spark, order):
    """One outlier in time, text and boolean orders, and equal first values."""
    df = spark.range(4_000).select(
        "id", F.lit("g").alias("key"), F.when(F.col("id") == 7, 10**15).otherwise(F.col("id") % 5).alias("t"),
        F.format_string("%05d", F.col("id")).alias("text"), (F.col("id") % 2 == 0).alias("flag"),
    )
    cut = W._cut(df, ["key"], [F.col(order), F.col("id")], 400)
    sizes = [r["n"] for r in cut.rows.groupBy("_slice").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 4_000 and max(sizes) <= 800
    got = W.running(df, ["key"], [order, "id"], F.col("id"), "total", max_rows=400)
    assert rows(got) == rows(W.running(df, ["key"], [order, "id"], F.col("id"), "total", max_rows=10**9))


@SLOW
@given(ORDERED, st.integers(0, 9), st.sampled_from(["min", "max"]))
def test_moving_extremes_are_plain_frames(spark, pairs, n, pick):
    timed = ordered(spark, pairs).withColumns({"ts": F.timestamp_seconds("t"), "v": F.when(F.col("v") != 3, F.col("v"))})
    take = F.max if pick == "max" else F.min
    group = Window.partitionBy("key")
    by_rows = timed.withColumn("x", take("v").over(group.orderBy("t", "id").rowsBetween(-n, 0)))
    by_time = timed.withColumn("x", take("v").over(group.orderBy("t").rangeBetween(-n, 0)))
    for limit in (4, 10**9):
        assert rows(W.moving_rows_extreme(timed, ["key"], ["t", "id"], F.col("v"), "x", n, pick, limit)) == rows(by_rows)
        assert rows(W.moving_range_extreme(timed, ["key"], "ts", F.col("v"), "x", n, pick, limit)) == rows(by_time)


def test_ranks_of_a_hot_group_with_one_order_value(spark):
    df = spark.range(3_000).select("id", F.lit("a").alias("key"), F.when(F.col("id") < 2_900, 5).otherwise(F.col("id")).alias("t"))
    got = W.rank_in(df, ["key"], ["t"], ["id"], tiles=7, max_rows=200)
    assert rows(got) == rows(W.rank_in(df, ["key"], ["t"], ["id"], tiles=7, max_rows=10**9))
    # The window that numbers equals works on slices of them.
    cut = W._cut(df, ["key", "t"], [F.col("id")], 200)
    sizes = [r["n"] for r in cut.rows.where("_slice >= 0").groupBy("_slice").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 2_900 and max(sizes) <= 400


def test_schema_does_not_depend_on_size(spark):
    df = readings(spark, 300).withColumns({"price": F.col("amount").cast("decimal(12,2)"), "ts": F.timestamp_seconds("id")})
    for call in (
        lambda n: W.rank_in(df, ["key"], ["id"], ["amount"], max_rows=n),
        lambda n: W.shift_in(df, ["key"], ["id"], "price", max_rows=n),
        lambda n: W.running(df, ["key"], ["id"], F.col("price"), "x", max_rows=n),
        lambda n: W.moving_rows(df, ["key"], ["id"], F.col("price"), "x", 3, max_rows=n),
        lambda n: W.moving_range(df, ["key"], "ts", F.col("price"), "x", 9, max_rows=n),
        lambda n: W.carry_last(df, ["key"], ["id"], "price", "x", max_rows=n),
        lambda n: W.moving_rows_extreme(df, ["key"], ["id"], F.col("price"), "x", 3, max_rows=n),
        lambda n: W.moving_range_extreme(df, ["key"], "ts", F.col("price"), "x", 9, max_rows=n),
    ):
        assert call(10).dtypes == call(10**9).dtypes


def test_full_join_spreads_the_side_that_is_hot(spark):
    left = spark.range(3_000).select(F.lit("a").alias("key"), F.col("id").alias("x"))
    right = spark.createDataFrame([("a", 1), ("b", 2)], "key string, y long")
    joined = S.outer_join(left, right, ["key"], "full", max_rows=100)
    assert rows(joined) == rows(left.join(right, "key", "full"))
    exploded = [line for line in executed(joined).split("Initial Plan")[0].splitlines() if "Generate explode" in line]
    assert exploded and all("x#" not in line for line in exploded)


def test_salted_repartition_evens_partitions(spark):
    df = readings(spark, 20_000).withColumn("key", F.when(F.col("id") < 12_000, "busy").otherwise(F.col("key")))
    hot = S.hot_predicate(df, "key", 0.2)
    plain = S.partition_skew(S.partition_sizes(df.repartition(8, "key"), 8)).first()
    even = S.partition_skew(S.partition_sizes(S.salted_repartition(df, ["key"], hot, 8, 64, ["id"]), 8)).first()
    assert plain["skewed"] and not even["skewed"]
    assert plain["rows"] == even["rows"] == 20_000


def test_empty_partitions_count(spark):
    one = spark.range(100).select(F.lit("x").alias("k")).repartition(8, "k")
    report = S.partition_skew(S.partition_sizes(one, 8)).first()
    assert (report["partitions"], report["empty"], report["max_rows"], report["ratio"]) == (8, 7, 100, 8.0)


def test_adaptive_execution_splits_a_skewed_join(spark, conf):
    conf(
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        }
    )
    busy = readings(spark, 400_000).withColumn("key", F.when(F.col("id") < 200_000, "busy").otherwise(F.col("key")))
    plan = executed(J.sort_merge_join(busy, sensors(spark), ["key"]))
    assert "skew=true" in plan


@pytest.mark.parametrize("share, expected", [(0.05, ["busy"]), (0.5, [])])
def test_hot_keys_by_share(spark, share, expected):
    assert [r["key"] for r in S.hot_keys(readings(spark, 3_000), ["key"], share).collect()] == expected


def test_top_n_keeps_few_rows_per_task(spark):
    plan = executed(W.top_n_per(readings(spark, 3_000), ["key"], [F.desc("amount"), F.asc("id")], 2))
    assert "WindowGroupLimit" in plan


def test_window_helper_matches_builtin(spark):
    df = readings(spark, 2_000)
    w = Window.partitionBy("key").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(W.running(df, ["key"], ["id"], F.col("amount"), "t")) == rows(df.withColumn("t", F.sum("amount").over(w)))
