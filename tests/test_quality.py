from __future__ import annotations

import pandas as pd
import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F, types as T

from tests.conftest import rows
from weftline.operators import aggregates as A, changes as H, governance as G, pandas_groups as P, quality as Q
from weftline.operators.hierarchy import walk
from weftline.operators.reuse import persisted, refresh
from weftline.session import scratch


def test_schema_contract(spark):
    raw = spark.createDataFrame([("1", "x", 1), ("y", "2", 2), (None, "3", 3)], "a string, b string, c int")
    contract = T.StructType().add("a", "integer").add("b", "string").add("d", "date")
    found = {(r["column_name"], r["problem"]): r["rows"] for r in Q.check_schema(raw, contract).collect()}
    assert found == {("a", "type"): None, ("a", "unparsable"): 1, ("c", "unexpected"): None, ("d", "missing"): None}
    assert Q.check_schema(raw, raw.schema).count() == 0


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (3, None), (3, "b")], "n int, s string")
    found = {r["column_name"]: tuple(r)[1:] for r in Q.profile(df).collect()}
    assert found["n"] == (3, 0, 2, "1", "3", 7 / 3)
    assert found["s"] == (3, 1, 2, "a", "b", None)
    assert rows(Q.profile(df, exact=True)) == rows(Q.profile(df))
    small = spark.createDataFrame([(2e-7, 1e25), (4e-7, 1e25)], "a double, b double")
    means = {r["column_name"]: r["mean"] for r in Q.profile(small).collect()}
    assert means["a"] == pytest.approx(3e-7) and means["b"] == pytest.approx(1e25)


def test_exact_profile_bounds_its_tasks(spark, monkeypatch):
    monkeypatch.setattr(Q, "CELLS_PER_TASK", 100)
    odd = F.when(F.col("id") % 4 == 0, float("nan")).when(F.col("id") % 4 == 1, -0.0).when(F.col("id") % 4 == 2, 0.0)
    df = spark.range(0, 1_000, 1, 1).select("id", F.concat(F.lit("s"), F.col("id") % 700).alias("s"), odd.alias("x"), F.lit(None).cast("int").alias("none"))
    profile = Q.profile(df, exact=True)
    # One task holds all rows; they are dealt to tasks of 100 values before they are copied per column.
    assert "40), REPARTITION_BY_NUM" in profile._jdf.queryExecution().executedPlan().toString()
    assert {r["column_name"]: r["ndv"] for r in profile.collect()} == {"id": 1_000, "s": 700, "x": 2, "none": 0}
    assert {r["column_name"]: r["ndv"] for r in Q.profile(df.limit(0), exact=True).collect()} == dict.fromkeys(df.columns, 0)


def test_reconcile_counts_copies(spark):
    a = spark.createDataFrame([(1, "x")] * 3 + [(2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x")] + [(2, None)] * 2 + [(3, "z")], "k int, v string")
    assert tuple(Q.reconcile(a, b).first()) == (4, 4, 2, 2)
    assert tuple(Q.reconcile(a, a).first()) == (4, 4, 0, 0)
    assert Q.fingerprint(a).first() == Q.fingerprint(a.orderBy(F.desc("k"))).first()
    assert Q.fingerprint(a).first() != Q.fingerprint(b).first()


def test_rules(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 50), (None, 7)], "k int, v int")
    dim = spark.createDataFrame([(1,)], "id int")
    rules = {
        "present": Q.NotNull("v"),
        "range": Q.InRange("v", 0, 10),
        "unique": Q.Unique(("k",)),
        "known": Q.ForeignKey("k", dim, "id"),
    }
    assert dict(map(tuple, Q.check_rules(df, rules).collect())) == {"present": 1, "range": 1, "unique": 1, "known": 1}
    with pytest.raises(TypeError):
        Q.check_rules(df, {"odd": "rule"})


def test_anomaly_finds_the_spike(spark):
    days = [("a", d, 100 + d % 3) for d in range(30)] + [("a", 30, 900)] + [("b", d, 5) for d in range(5)]
    daily = spark.createDataFrame(days, "g string, day int, n long")
    found = Q.anomalies(daily, ["g"], "day", "n", z=4.0).where("anomaly").collect()
    assert [(r["g"], r["day"], r["change"]) for r in found] == [("a", 30, 798)]


def test_anomaly_of_small_values(spark):
    daily = spark.createDataFrame([("a", d, 0.001) for d in range(9)] + [("a", 9, 0.004), ("b", 0, None)], "g string, day int, n double")
    found = {(r["g"], r["day"]): r["z"] for r in Q.anomalies(daily, ["g"], "day", "n").collect()}
    assert round(found["a", 9], 2) == 2.85 and found["b", 0] is None


def test_null_handling(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "a int, b string")
    assert rows(Q.fill_nulls(df, {"a": 0, "b": "?"})) == [(0, "x"), (1, "?")]
    assert rows(Q.drop_nulls(df, ["a"])) == [(1, None)]


BASE = [(1, "a"), (2, "b"), (3, "c")]
CHANGES = [(1, "a2", "update", 1), (1, "a3", "update", 2), (2, None, "delete", 5), (4, "d", "insert", 1), (4, None, "delete", 2), (5, "e", "insert", 1)]


def test_cdc_and_merge(spark):
    base = spark.createDataFrame(BASE, "k int, v string")
    changes = spark.createDataFrame(CHANGES, "k int, v string, op string, seq int")
    expected = [(1, "a3"), (3, "c"), (5, "e")]
    assert rows(H.apply_cdc(base, changes, ["k"], ["seq"]), "k", "v") == expected
    source = H.latest(changes, ["k"], ["seq"])
    assert rows(H.merge(base, source, ["k"], ["v"], F.col("op") == "delete"), "k", "v") == expected
    kept = H.merge(base, source.drop("op"), ["k"], ["v"])
    assert rows(kept, "k", "v") == rows(spark.createDataFrame([(1, "a3"), (2, None), (3, "c"), (4, None), (5, "e")], "k int, v string"))


def test_history(spark):
    changes = spark.createDataFrame([("k", 1, "a"), ("k", 5, "b"), ("m", 3, "c")], "key string, at int, v string")
    history = H.scd2(changes, ["key"], "at")
    assert rows(history, "key", "valid_from", "valid_to") == [("k", 1, 5), ("k", 5, None), ("m", 3, None)]
    assert rows(H.as_of(history, F.lit(4)), "v") == [("a",), ("c",)]
    assert rows(H.as_of(history, F.lit(5)), "v") == [("b",), ("c",)]
    assert rows(H.as_of(history, F.lit(0)), "v") == []
    late = H.incremental(changes, "at", F.lit(3))
    assert rows(late, "v") == [("b",)]


def test_audit_line_per_write(spark):
    trail = scratch(spark, "trail")
    for n in (3, 0):
        G.write_audited(spark.range(n), scratch(spark, "out"), trail, f"run{n}", top=F.max("id"))
    assert rows(spark.read.parquet(trail), "run", "rows") == [("run0", 0), ("run3", 3)]


def test_masks(spark):
    df = spark.createDataFrame([("4111-22", 1234.5), ("ab", -1.0), (None, None)], "card string, x double")
    masked = G.mask(df, {"card": G.partial(2), "x": G.bucketed(100)}).collect()
    assert [tuple(r) for r in masked] == [("*****22", 1200), ("ab", -100), (None, None)]
    assert G.mask(df, {"card": G.hashed}).first()["card"] != "4111-22"


def test_row_security(spark):
    df = spark.range(6).select("id", (F.col("id") % 3).alias("team"))
    rights = spark.createDataFrame([("ana", 1), ("ana", 1), ("ben", 2)], "user string, team long")
    assert rows(G.row_security(df, rights, "ana", "team"), "id") == [(1,), (4,)]
    assert G.row_security(df, rights, "eve", "team").count() == 0


def test_persisted_is_released(spark):
    df = spark.range(100)
    for level in (StorageLevel.MEMORY_ONLY, StorageLevel.MEMORY_AND_DISK, StorageLevel.DISK_ONLY):
        with pytest.raises(RuntimeError):
            with persisted(df, level) as base:
                assert base.is_cached and base.count() == 100
                raise RuntimeError
        assert not df.is_cached


def test_refresh_sees_new_files(spark):
    path = scratch(spark, "r")
    spark.range(5).write.parquet(path)
    old = spark.read.parquet(path).persist()
    assert old.count() == 5
    spark.range(5).write.mode("append").parquet(path)
    assert refresh(spark, path, old).count() == 10


def test_walk_stops_in_a_cycle(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (2, 3), (1, 3), (5, 4), (9, None)], "node long, parent long")
    roots = spark.createDataFrame([(1,)], "node long")
    assert rows(walk(edges, roots), "depth", "node") == [(0, 1), (1, 2), (2, 3)]


def test_walk_counts_a_node_once_and_goes_to_the_end(spark):
    diamond = [(2, 1), (3, 1), (4, 2), (4, 3)]
    chain = [(101 + i, 100 + i) for i in range(79)]
    edges = spark.createDataFrame(diamond + chain, "node long, parent long")
    found = rows(walk(edges, spark.createDataFrame([(1,), (100,)], "node long")), "node", "depth")
    assert found == sorted([(1, 0), (2, 1), (3, 1), (4, 2)] + [(100 + i, i) for i in range(80)], key=repr)


def test_percentiles_of_one_hot_group(spark, conf):
    conf(spark__weftline__hotRows="5")
    df = spark.range(101).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    found = A.exact_percentiles(df, ["g"], "v", {"p10": 0.1, "p50": 0.5, "p999": 0.999}).first()
    assert (found["p10"], found["p50"], round(found["p999"], 9)) == (10.0, 50.0, 99.9)


def test_percentiles_of_nulls_only(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), (None, 3.0)], "g string, v double")
    assert rows(A.exact_percentiles(df, ["g"], "v", {"p": 0.5})) == [("a", 1.0), ("b", None), (None, 3.0)]


def test_pandas_lookup_equals_join(spark, monkeypatch):
    df = spark.range(10).select((F.col("id") % 4).alias("k"))
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (2, None)], "id long, name string")
    joined = df.join(dim, F.col("k") == F.col("id"), "left").select("k", "name")
    assert rows(P.lookup(df, dim, "k", "id", "name", "name")) == rows(joined)
    monkeypatch.setattr(P, "fits", lambda dim: False)
    assert rows(P.lookup(df, dim, "k", "id", "name", "name")) == rows(joined)


def test_vectorised_one_and_two_columns(spark):
    df = spark.range(3).select(F.col("id").cast("double").alias("a"), F.lit(2.0).alias("b"))
    both = df.select(P.vectorised(lambda a, b: a * b, "double", "a", "b").alias("x"), P.vectorised(lambda a: a + 1, "double", "a").alias("y"))
    assert rows(both) == [(0.0, 1.0), (2.0, 2.0), (4.0, 3.0)]


def test_per_group_cuts_or_takes_whole_groups(spark):
    df = spark.range(200).select(F.lit(1).alias("k"), "id")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": [1], "n": [len(pdf)]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": [1], "n": [pdf["n"].sum()]})

    assert rows(P.per_group(df, ["k"], count, "k int, n long", merge=add, max_rows=50)) == [(1, 200)]
    assert rows(P.per_group(df, ["k"], count, "k int, n long", max_rows=50)) == [(1, 200)]


def test_second_largest(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 3.0), ("b", 2.0), ("b", None), ("c", None)], "k string, v double")
    assert rows(P.second_largest(df, ["k"], "v"), "k", "largest", "second") == [("a", 3.0, 1.0), ("b", 2.0, None)]
