"""Reports over a log that a real session wrote, and over hand-made lines."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tests.conftest import rows
from weftline.operators import telemetry as T


def task(stage=1, n=1, start=0, end=1000, run=900, gc=0, spilled=0, reason="Success", executor="1", app="a", **more):
    metrics = {
        "Executor Run Time": run,
        "JVM GC Time": gc,
        "Memory Bytes Spilled": spilled,
        "Disk Bytes Spilled": spilled // 2,
        "Input Metrics": {"Bytes Read": more.get("read", 100)},
        "Shuffle Read Metrics": {"Remote Bytes Read": more.get("remote", 0), "Local Bytes Read": 10, "Fetch Wait Time": more.get("wait", 0)},
        "Shuffle Write Metrics": {"Shuffle Bytes Written": more.get("written", 0), "Shuffle Write Time": 0},
    }
    info = {"Task ID": n, "Launch Time": start, "Finish Time": end, "Executor ID": executor, "Locality": "ANY", "Failed": False}
    event = {"Event": "SparkListenerTaskEnd", "Stage ID": stage, "Stage Attempt ID": 0, "Task Info": info}
    return app, json.dumps({**event, "Task End Reason": {"Reason": reason}, "Task Metrics": metrics})


def log(spark, *lines):
    return T.parse(spark.createDataFrame(list(lines), "app string, value string"))


def test_stragglers_and_spill(spark):
    even = [task(stage=1, n=i, end=1000) for i in range(5)]
    uneven = [task(stage=2, n=10 + i, end=1000, spilled=8) for i in range(4)] + [task(stage=2, n=20, end=9000)]
    tasks = T.tasks(log(spark, *even, *uneven, ("a", "{broken")))
    found = {r["stage_id"]: r for r in T.stragglers(tasks).collect()}
    assert not found[1]["uneven"] and found[2]["uneven"]
    assert (found[2]["ratio"], found[2]["slowest_task"]) == (9.0, 20)
    spilled = {r["stage_id"]: tuple(r)[2:] for r in T.spill(tasks).collect()}
    assert spilled == {1: (0, 0, 0), 2: (32, 16, 4)}


def test_gc_bands(spark):
    shares = {"1": 10, "2": 70, "3": 150, "4": 300}
    tasks = T.tasks(log(spark, *[task(n=i, executor=e, run=1000, gc=g) for i, (e, g) in enumerate(shares.items())]))
    bands = {r["executor"]: r["band"] for r in T.gc_share(tasks).collect()}
    assert bands == {"1": "healthy", "2": "watch", "3": "warning", "4": "critical"}


def test_shuffle_alerts(spark):
    tasks = T.tasks(log(spark, task(remote=990, read=100, wait=500, run=900), task(app="b", remote=10, read=100)))
    assert {r["app"]: r["alert"] for r in T.shuffle_ratio(tasks).collect()} == {"a": False, "b": False}
    more = T.tasks(log(spark, task(remote=2000, read=100, wait=500, run=900)))
    assert T.shuffle_ratio(more).first()["alert"] and T.shuffle_time(more).first()["alert"]
    none_read = T.tasks(log(spark, task(read=0)))
    assert T.shuffle_ratio(none_read).first()["ratio"] is None


def test_failures_and_compare(spark):
    tasks = T.tasks(log(spark, task(reason="ExecutorLostFailure"), task(app="b", run=400), task(app="b", run=100)))
    assert [tuple(r) for r in T.failures(tasks).collect()] == [("a", "ExecutorLostFailure", 1, 1, 1)]
    compared = T.compare_runs(tasks, "a", "b").first()
    assert (compared["run_ms_before"], compared["run_ms_change"]) == (900, -400)


def test_executor_timeline(spark):
    moves = [("Added", 1, 10), ("Added", 2, 10), ("Removed", 1, 30), ("Added", 3, 40), ("Removed", 2, 40)]
    lines = [("a", json.dumps({"Event": f"SparkListenerExecutor{m}", "Timestamp": t, "Executor ID": str(e)})) for m, e, t in moves]
    assert rows(T.executor_timeline(log(spark, *lines)), "at_ms", "executors") == [(10, 2), (30, 1), (40, 1)]


def test_real_log(spark, event_log_dir):
    spark.range(100_000).groupBy((F.col("id") % 10).alias("k")).count().collect()
    events = T.read_event_log(spark, f"file://{event_log_dir}")
    app = spark.sparkContext.applicationId
    tasks = T.tasks(events)
    assert tasks.select("app").distinct().first()[0].startswith(app)
    assert tasks.where("duration_ms < 0 OR run_ms IS NULL").count() == 0
    assert tasks.agg(F.sum("shuffle_written")).first()[0] > 0
    summary = T.jobs(events).first()
    assert summary["jobs"] > 0 and summary["stages"] >= 1 and summary["job_ms"] >= 0
    assert T.slow_sql(events, 0).where("plan LIKE '%HashAggregate%'").count() > 0
    assert T.executor_timeline(events).agg(F.max("executors")).first()[0] == 1
    for report in (T.stragglers, T.spill, T.gc_share, T.shuffle_ratio, T.shuffle_time, T.locality):
        assert report(tasks).count() > 0
