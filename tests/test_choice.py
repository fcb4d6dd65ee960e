"""Repeatable samples, joins reduced by key filters, the partition report."""

from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from weftline.operators import reduction as R, samples as P
from weftline.plans.inspect import executed
from weftline.plans.registry import QUERIES


def draw(row_id, seed):
    text = f"{seed}:{'' if row_id is None else row_id}"
    return (int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def numbered(spark, n=6_000):
    """A third of the rows in one group; one group has no name."""
    group = F.when(F.col("id") % 3 == 0, "busy").when(F.col("id") % 50 == 1, None).otherwise(F.format_string("g%d", F.col("id") % 40))
    weight = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 7 == 0, 0.0).otherwise(1.0 + F.col("id") % 5)
    return spark.range(n).select("id", group.alias("g"), weight.alias("w"))


@pytest.mark.parametrize("weight", [None, "w"])
def test_sample_is_the_smallest_draws(spark, weight):
    df = numbered(spark)
    groups = {}
    for r in df.collect():
        if weight and not (r["w"] and r["w"] > 0):
            continue
        u = draw(r["id"], 5)
        groups.setdefault(r["g"], []).append((-math.log(u) / r["w"] if weight else u, r["id"]))
    want = sorted(((g, i) for g, d in groups.items() for _, i in sorted(d)[:9]), key=repr)
    assert rows(P.sample_per_group(df, ["g"], 9, ["id"], 5, weight), "g", "id") == want


def test_sample_does_not_depend_on_partitions(spark):
    df = numbered(spark)
    one = rows(P.sample_per_group(df.coalesce(1), ["g"], 5, ["id"]))
    assert one == rows(P.sample_per_group(df.repartition(23, "w"), ["g"], 5, ["id"], salts=3))
    plan = executed(P.sample_per_group(df, ["g"], 5, ["id"]))
    assert "WindowGroupLimit" in plan


def test_shares_grow_and_weights_count(spark):
    df = numbered(spark, 20_000)
    small, large = (set(rows(P.sample_share(df, s, ["id"], 2), "id")) for s in (0.1, 0.3))
    assert small < large and abs(len(small) - 2_000) < 200 and abs(len(large) - 6_000) < 300
    even = df.select("id", F.lit("all").alias("g"), F.when(F.col("id") < 10_000, 4.0).otherwise(1.0).alias("w"))
    drawn = [r["id"] for r in P.sample_per_group(even, ["g"], 1_000, ["id"], weight="w").collect()]
    assert len(drawn) == 1_000 and 0.74 < sum(i < 10_000 for i in drawn) / 1_000 < 0.85


def test_small_groups_empty_tables_and_repeated_ids(spark):
    few = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", 2)], "g string, id long")
    assert len(rows(P.sample_per_group(few, ["g"], 9, ["id"]))) == 4
    assert P.sample_per_group(few.limit(0), ["g"], 9, ["id"]).count() == 0


def star(spark):
    fact = spark.range(9_000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 500).alias("f_mid")
    )
    mid = spark.range(500).select(F.col("id").alias("m_id"), F.when(F.col("id") % 9 > 0, F.col("id") % 25).alias("m_far"))
    far = spark.range(25).select(F.col("id").alias("r_id"), F.format_string("far%d", "id").alias("name")).where("r_id < 3")
    edges = [R.Edge("fact", "mid", [("f_mid", "m_id")]), R.Edge("mid", "far", [("m_far", "r_id")])]
    return {"fact": fact, "mid": mid, "far": far}, edges


@pytest.mark.parametrize("down", [(), ("mid", "far")])
@pytest.mark.parametrize("max_rows", [1_000, 0])
def test_reduction_keeps_the_join(spark, down, max_rows):
    tables, edges = star(spark)
    reduced = R.reduce_tables(tables, edges, down, max_rows=max_rows)
    join = lambda t: t["fact"].join(t["mid"], F.col("f_mid") == F.col("m_id")).join(t["far"], F.col("m_far") == F.col("r_id"))
    plain = join(tables)
    assert rows(join(reduced)) == rows(plain) == rows(R.reduced_join(tables, edges, "fact", down))
    if max_rows:  # only rows that survive the whole tree are left before the large join
        assert reduced["fact"].count() == plain.count() < tables["fact"].count() / 2
    else:
        assert reduced["fact"].count() == tables["fact"].count()
    if max_rows and down:
        assert rows(reduced["mid"], "m_id") == rows(plain.select("m_id").distinct())


def test_key_filter_runs_before_the_shuffle(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    tables, edges = star(spark)
    plan = executed(R.reduced_join(tables, edges, "fact")).split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "SortMergeJoin" in plan
    semi = next(i for i, line in enumerate(plan.splitlines()) if "LeftSemi" in line and "f_mid" in line)
    above = plan.splitlines()[:semi]
    assert any("Exchange hashpartitioning(f_mid" in line for line in above)


def test_partition_report_is_the_real_one(spark, sf_dir):
    report = QUERIES["partition_report"](spark, sf_dir).first()
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.concat_ws("_", "l_returnflag", "l_linestatus").alias("key"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = [r["count"] for r in lines.repartition(n, "key").groupBy(F.spark_partition_id()).count().collect()]
    assert (report["partitions"], report["empty"], report["max_rows"], report["rows"]) == (n, n - len(held), max(held), sum(held))
    assert report["ratio"] == max(held) * n / sum(held)
