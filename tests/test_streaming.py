from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import rows
from weftline.session import scratch
from weftline.streaming import shards, sinks as K, sources as S, windows as W
from weftline.streaming.handles import activity
from weftline.streaming.state import keyed_state

SCHEMA = "id long, k string, at timestamp, v long"


class Feed:
    """A folder that gets one file per batch of rows."""

    def __init__(self, spark):
        self.spark, self.path = spark, scratch(spark, "feed")
        self.checkpoint = scratch(spark, "checkpoint")

    def add(self, *data):
        seconds = [(i, k, t, v) for i, k, t, v in data]
        df = self.spark.createDataFrame(seconds, "id long, k string, t long, v long")
        df.select("id", "k", F.timestamp_seconds("t").alias("at"), "v").coalesce(1).write.mode("append").parquet(self.path)
        return self

    def read(self):
        session = S.stream_session(self.spark)
        return S.stream(session, self.path, self.spark.read.parquet(self.path).schema, max_files=1)


@pytest.fixture
def feed(spark):
    return Feed(spark)


def test_late_rows_are_dropped_and_counted(spark, feed):
    feed.add((1, "a", 100, 1), (2, "a", 90_000, 1)).add((3, "a", 200_000, 1)).add((4, "a", 150, 1), (5, "a", 160, 1), (6, "b", 199_000, 1))
    counts = W.tumbling(feed.read(), "at", "1 day", "1 hour", [F.count("*").alias("n")], keys=["id"])
    out = scratch(spark, "out")
    done = K.finish(K.upsert_sink(counts, out, ["window_start", "id"], ["n"], feed.checkpoint, "update"))
    assert rows(K.read_upserts(spark, out, ["window_start", "id"]), "id") == [(1,), (2,), (3,), (6,)]
    assert K.dropped_by_watermark(done) == 2


def test_late_counter_is_a_lower_bound_without_the_key(spark, feed):
    # A row is late when it is older than the watermark of the batch before.
    feed.add((1, "a", 100, 1)).add((3, "a", 200_000, 1)).add((2, "a", 200_001, 1)).add((4, "a", 150, 1), (5, "a", 160, 1))
    counts = W.tumbling(feed.read(), "at", "1 day", "1 hour", [F.count("*").alias("n")])
    out = scratch(spark, "out")
    done = K.finish(K.upsert_sink(counts, out, ["window_start"], ["n"], feed.checkpoint, "update"))
    assert K.dropped_by_watermark(done) == 1
    received = spark.read.parquet(feed.path).groupBy(F.date_trunc("day", "at").alias("window_start")).agg(F.count("*").alias("n"))
    report = K.late_report(received, K.read_upserts(spark, out, ["window_start"]), ["window_start"])
    assert rows(report, "received", "accepted", "late") == [(2, 2, 0), (3, 1, 2)]


def test_intake_limit(spark, feed):
    for i in range(4):
        feed.add((i, "a", i, 1))
    done = K.finish(K.sink(feed.read(), scratch(spark, "out"), feed.checkpoint))
    assert [p.numInputRows for p in done.recentProgress if p.numInputRows] == [1, 1, 1, 1]


def test_dedup_across_batches(spark, feed):
    feed.add((1, "a", 100, 1), (1, "a", 100, 1), (2, "b", 110, 1)).add((2, "b", 110, 1), (3, "c", 120, 1))
    out = scratch(spark, "out")
    unique = W.dedup(feed.read(), ["id"], "at", "1 hour")
    K.finish(K.sink(unique, out, feed.checkpoint))
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,), (3,)]


def test_restart_continues(spark, feed):
    out = scratch(spark, "out")
    feed.add((1, "a", 1, 1))
    K.finish(K.sink(feed.read(), out, feed.checkpoint))
    feed.add((2, "a", 2, 1))
    for _ in range(2):
        K.finish(K.sink(feed.read(), out, feed.checkpoint))
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,)]


def test_upsert_batch_may_run_again(spark, feed):
    feed.add((1, "a", 1, 10), (2, "a", 2, 20)).add((3, "a", 3, 30), (4, "b", 3, 40))
    out = scratch(spark, "out")
    query = lambda checkpoint: K.upsert_sink(feed.read(), out, ["k"], ["at", "id"], checkpoint)
    K.finish(query(feed.checkpoint))
    first = rows(K.read_upserts(spark, out, ["k"]), "k", "v")
    assert first == [("a", 30), ("b", 40)]
    # A lost checkpoint replays the same batches into the same folders.
    K.finish(query(scratch(spark, "checkpoint")))
    assert rows(K.read_upserts(spark, out, ["k"]), "k", "v") == first
    target = scratch(spark, "compacted")
    K.compact_upserts(spark, out, target, ["k"])
    assert rows(K.read_upserts(spark, target, ["k"]), "k", "v") == first


def test_interval_join_is_brute_force(spark, feed):
    data = [(i, "hot" if i % 3 else f"k{i}", (i * 37) % 1000 + i * 10, i % 2) for i in range(120)]
    data.sort(key=lambda r: r[2])
    feed.add(*data[:60]).add(*data[60:])
    source = feed.read()
    a = source.where("v = 0").select("k", F.col("id").alias("a"), F.col("at").alias("a_at"))
    b = source.where("v = 1").select("k", F.col("id").alias("b"), F.col("at").alias("b_at"))
    out = scratch(spark, "out")
    joined = W.interval_join(a, b, "k", "a_at", "b_at", 90, "1 hour")
    K.finish(K.sink(joined.select("a", "b"), out, feed.checkpoint))
    expected = sorted(
        (x[0], y[0]) for x in data for y in data if x[3] == 0 and y[3] == 1 and x[1] == y[1] and 0 <= y[2] - x[2] <= 90
    )
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("a", "b").collect())
    assert got == expected and len(got) > 20


def test_keyed_state_expires(spark, feed):
    feed.add((1, "a", 100, 5), (2, "a", 110, 6)).add((3, "b", 100_000, 1)).add((4, "a", 100_100, 7))
    out = scratch(spark, "out")
    totals = keyed_state(feed.read(), "k", "v", "at", "10 seconds", idle_seconds=60)
    K.finish(K.batch_sink(totals, out, feed.checkpoint, "update"))
    found = rows(spark.read.parquet(out), "k", "n", "amount", "closed")
    assert ("a", 2, 11, False) in found and ("a", 2, 11, True) in found
    assert ("a", 1, 7, False) in found and ("b", 1, 1, False) in found


def test_keyed_state_shares_the_state_of_a_shard(spark, feed, monkeypatch):
    monkeypatch.setattr(shards, "SHARDS", 2)
    feed.add(*[(i, f"k{i}", 100, i) for i in range(300)], (0, "k0", 100, None), (5, None, 100, 1), (6, "timeless", None, 1))
    feed.add((7, "k7", 100_000, 1), (9, "timeless", 120, 3)).add((8, "k8", 100_100, 2))
    out = scratch(spark, "out")
    totals = keyed_state(feed.read(), "k", "v", "at", "10 seconds", idle_seconds=60)
    done = K.finish(K.batch_sink(totals, out, feed.checkpoint, "update"))
    found = spark.read.parquet(out)
    first = {(f"k{i}", 1 + (i == 0), i) for i in range(300)} | {(None, 1, 1)}
    closed = first - {("k7", 1, 7)} | {("k7", 2, 8), ("timeless", 2, 4)}
    assert rows(found.where("closed"), "k", "n", "amount") == sorted(closed, key=repr)
    still = {("k7", 2, 8), ("timeless", 1, 1), ("timeless", 2, 4), ("k8", 1, 2)}
    assert rows(found.where("NOT closed"), "k", "n", "amount") == sorted(first | still, key=repr)
    # The store has a row per shard and not one per key.
    assert max(op.numRowsTotal for p in done.recentProgress for op in p.stateOperators) == 2


def test_activity_keeps_newest_rows_counts_and_expires(spark, feed):
    feed.add((1, "a", 100, 5), (2, "a", 110, 6), (3, "a", 105, None)).add((4, "b", 100_000, 1)).add((5, "a", 100_100, 7))
    out = scratch(spark, "out")
    sign = F.when(F.col("v") % 2 == 0, "even").when(F.col("v") % 2 == 1, "odd")
    seen = lambda: activity(feed.read().withColumn("sign", sign), "k", "sign", "v", "at", "id", "10 seconds", 2, idle_seconds=60)
    columns = ("k", "n", "amount", "last_events", "kinds", "closed")
    K.finish(K.batch_sink(seen(), out, feed.checkpoint, "update"))
    found = rows(spark.read.parquet(out), *columns)
    assert ("a", 3, 11, "3,2", "even=1,odd=1", False) in found and ("a", 3, 11, "3,2", "even=1,odd=1", True) in found
    assert ("a", 1, 7, "5", "odd=1", False) in found and ("b", 1, 1, "4", "odd=1", False) in found
    # Started again from the checkpoint, the state goes on.
    feed.add((6, "a", 100_110, 2), (7, None, 100_120, 9))
    K.finish(K.batch_sink(seen(), out, feed.checkpoint, "update"))
    found = rows(spark.read.parquet(out), *columns)
    assert ("a", 2, 9, "5,6", "even=1,odd=1", False) in found and (None, 1, 9, "7", "odd=1", False) in found


def test_activity_shares_the_state_of_a_shard(spark, feed, monkeypatch):
    monkeypatch.setattr(shards, "SHARDS", 2)
    big = 2**60 + 1
    feed.add(*[(big + i, f"k{i}", 100, i) for i in range(300)], (None, "k0", 100, None), (5, None, 100, 1), (6, "timeless", None, 1))
    feed.add((7, "k7", 100_000, 1), (9, "timeless", 120, 3)).add((8, "k8", 100_100, 2))
    out = scratch(spark, "out")
    even = F.when(F.col("v") % 2 == 0, "even")
    seen = activity(feed.read().withColumn("even", even), "k", "even", "v", "at", "id", "10 seconds", 2, idle_seconds=60)
    done = K.finish(K.batch_sink(seen, out, feed.checkpoint, "update"))
    found = spark.read.parquet(out)
    first = {(f"k{i}", 1 + (i == 0), i, f"{big + i}", "even=1" if i % 2 == 0 else "") for i in range(300)} | {(None, 1, 1, "5", "")}
    columns = ("k", "n", "amount", "last_events", "kinds")
    # Each key is closed once, when its own time is up; new rows start again.
    k7, timeless = ("k7", 2, 8, f"{big + 7},7", ""), ("timeless", 2, 4, "9", "")
    closed = first - {("k7", 1, 7, f"{big + 7}", "")} | {k7, timeless}
    assert rows(found.where("closed"), *columns) == sorted(closed, key=repr)
    still = {k7, timeless, ("k8", 1, 2, "8", "even=1"), ("timeless", 1, 1, "", "")}
    assert rows(found.where("NOT closed"), *columns) == sorted(first | still, key=repr)
    # The store has a few rows per shard and not a few per key.
    assert max(op.numRowsTotal for p in done.recentProgress for op in p.stateOperators) < 40


def test_split_bad_names_first_rule(spark):
    df = spark.createDataFrame([("1", 1), ("x", 1), (None, None)], "raw string, n int")
    rules = {"number": F.col("raw").try_cast("int").isNotNull(), "n": F.col("n").isNotNull()}
    good, bad = W.split_bad(df, rules)
    assert rows(good, "raw") == [("1",)]
    assert rows(bad, "raw", "reason") == sorted([("x", "number"), (None, "number")], key=repr)


def test_batch_and_stream_share_code(spark, sf_dir):
    from weftline.plans.streams import clean
    from weftline.sources.tables import load

    assert rows(clean(load(spark, sf_dir, "events"))) == rows(entry.queries()["st_filter_project"](spark, sf_dir))


def test_landing_cuts_rows_without_time_and_full_minutes(spark):
    path = scratch(spark, "landing-full")
    second = F.when(F.col("id") < 350, None).when(F.col("id") < 700, F.col("id") % 60).otherwise(F.col("id") * 60)
    S.land_in_order(spark.range(1000).select("id", F.timestamp_seconds(second).alias("at")), "at", path, rows_per_file=100)
    files = spark.read.parquet(path).select("at", "id", "_metadata.file_modification_time", "_metadata.file_path")
    spans = files.groupBy("file_path", "file_modification_time").agg(
        F.min(F.date_trunc("minute", "at")).alias("lo"), F.max(F.date_trunc("minute", "at")).alias("hi"), F.count("*").alias("n")
    )
    ordered = spans.orderBy("file_modification_time").collect()
    assert max(r["n"] for r in ordered) <= 100 and files.select("id").distinct().count() == files.count() == 1000
    nulls = [r["lo"] is None for r in ordered]
    assert sum(nulls) >= 4 and nulls == sorted(nulls, reverse=True)
    timed = [r for r in ordered if r["lo"] is not None]
    assert all(earlier["hi"] <= later["lo"] for earlier, later in zip(timed, timed[1:]))


def test_a_landed_file_is_read_by_several_tasks(spark, monkeypatch):
    import pyarrow.parquet as pq

    monkeypatch.setattr(S, "ROW_GROUP_BYTES", 1 << 18)
    path = scratch(spark, "landing-groups")
    S.land_in_order(spark.range(400_000).select(F.xxhash64("id").alias("h"), F.timestamp_seconds(F.col("id") % 9_000).alias("at")), "at", path)
    groups = [pq.ParquetFile(f.removeprefix("file://")).num_row_groups for f in spark.read.parquet(path).inputFiles()]
    assert max(groups) > 5


def test_landing_is_in_time_order(spark):
    path = scratch(spark, "landing")
    at = F.when(F.col("id") % 50 > 0, F.timestamp_seconds(F.col("id") * 60 * 7 % 60_000)).alias("at")
    S.land_in_order(spark.range(1000).select("id", at), "at", path, rows_per_file=100)
    times = spark.read.parquet(path).select("at", "_metadata.file_modification_time", "_metadata.file_path")
    spans = times.groupBy("file_path", "file_modification_time").agg(
        F.min("at").alias("lo"), F.max("at").alias("hi"), F.count("*").alias("n"), F.count_if(F.col("at").isNull()).alias("nulls")
    )
    ordered = spans.orderBy("file_modification_time").collect()
    assert max(r["n"] for r in ordered) <= 100 and [r["nulls"] > 0 for r in ordered] == [True] + [False] * (len(ordered) - 1)
    for earlier, later in zip(ordered, ordered[1:]):
        assert earlier["hi"] < later["lo"]
    assert spark.read.parquet(path).count() == 1000
