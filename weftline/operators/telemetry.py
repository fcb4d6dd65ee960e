"""Spark event logs as a dataset: stragglers, spill, garbage collection, shuffle cost.

The input has one line of JSON per event and the application it belongs to. Every
report is an ordinary aggregation and works on the logs of many applications at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftline.operators.aggregates import exact_percentiles
from weftline.operators.windows import running

# Names and types of the event log fields that are used.
EVENT_SCHEMA = """
    `Event` STRING, `Timestamp` BIGINT, `Executor ID` STRING, `Stage ID` INT, `Stage Attempt ID` INT,
    `Task End Reason` STRUCT<`Reason`: STRING>,
    `Task Info` STRUCT<`Task ID`: BIGINT, `Launch Time`: BIGINT, `Finish Time`: BIGINT, `Executor ID`: STRING,
        `Host`: STRING, `Locality`: STRING, `Failed`: BOOLEAN>,
    `Task Metrics` STRUCT<`Executor Run Time`: BIGINT, `JVM GC Time`: BIGINT,
        `Memory Bytes Spilled`: BIGINT, `Disk Bytes Spilled`: BIGINT,
        `Input Metrics`: STRUCT<`Bytes Read`: BIGINT>,
        `Shuffle Read Metrics`: STRUCT<`Remote Bytes Read`: BIGINT, `Local Bytes Read`: BIGINT, `Fetch Wait Time`: BIGINT>,
        `Shuffle Write Metrics`: STRUCT<`Shuffle Bytes Written`: BIGINT, `Shuffle Write Time`: BIGINT>>,
    `Job ID` INT, `Submission Time` BIGINT, `Completion Time` BIGINT, `Job Result` STRUCT<`Result`: STRING>,
    `Stage Info` STRUCT<`Stage ID`: INT, `Stage Attempt ID`: INT, `Stage Name`: STRING, `Number of Tasks`: INT,
        `Submission Time`: BIGINT, `Completion Time`: BIGINT, `Failure Reason`: STRING>,
    `executionId` BIGINT, `description` STRING, `physicalPlanDescription` STRING, `time` BIGINT
"""
SQL_START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
SQL_END = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd"
_ROLLED = r"eventlog_v2_([^/]+)/[^/]+$"


def parse(lines: DataFrame) -> DataFrame:
    """``app`` and ``value`` into ``app`` and the event's fields; a broken last line is left out.

    Unpacked with ``inline``, because a filter on the fields would otherwise be pushed
    below the projection and parse every line a second time.
    """
    event = F.from_json("value", EVENT_SCHEMA)
    return lines.select("app", F.inline(F.array(event))).where(F.col("Event").isNotNull())


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Event log files under ``path``, single or rolled; the application is taken from the file path."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    name = F.col("_metadata.file_path")
    rolled = F.regexp_extract(name, _ROLLED, 1)
    single = F.element_at(F.split(name, "/"), -1)
    return parse(lines.select(F.when(rolled != "", rolled).otherwise(single).alias("app"), "value"))


def _field(path: str) -> Column:
    parent, _, rest = path.partition(".")
    column = F.col(f"`{parent}`")
    for name in filter(None, rest.split(".")):
        column = column.getField(name)
    return column


# Column of the task table and its place in a task event.
_TASK_FIELDS = {
    "stage_id": "Stage ID",
    "attempt": "Stage Attempt ID",
    "reason": "Task End Reason.Reason",
    "task_id": "Task Info.Task ID",
    "executor": "Task Info.Executor ID",
    "host": "Task Info.Host",
    "locality": "Task Info.Locality",
    "failed": "Task Info.Failed",
    "launch_ms": "Task Info.Launch Time",
    "finish_ms": "Task Info.Finish Time",
    "run_ms": "Task Metrics.Executor Run Time",
    "gc_ms": "Task Metrics.JVM GC Time",
    "memory_spilled": "Task Metrics.Memory Bytes Spilled",
    "disk_spilled": "Task Metrics.Disk Bytes Spilled",
    "input_bytes": "Task Metrics.Input Metrics.Bytes Read",
    "remote_bytes": "Task Metrics.Shuffle Read Metrics.Remote Bytes Read",
    "local_bytes": "Task Metrics.Shuffle Read Metrics.Local Bytes Read",
    "fetch_wait_ms": "Task Metrics.Shuffle Read Metrics.Fetch Wait Time",
    "shuffle_written": "Task Metrics.Shuffle Write Metrics.Shuffle Bytes Written",
    "shuffle_write_ns": "Task Metrics.Shuffle Write Metrics.Shuffle Write Time",
}


def tasks(events: DataFrame) -> DataFrame:
    """One row per finished task."""
    ended = events.where(F.col("Event") == "SparkListenerTaskEnd")
    flat = ended.select("app", *[_field(path).alias(name) for name, path in _TASK_FIELDS.items()])
    return flat.withColumn("duration_ms", F.col("finish_ms") - F.col("launch_ms"))


def _ratio(a: Column, b: Column) -> Column:
    return a.cast("double") / F.nullif(b, F.lit(0))


def stragglers(tasks: DataFrame, ratio: float = 3.0) -> DataFrame:
    """Longest against median task per stage; uneven above ``ratio``."""
    stage = ["app", "stage_id"]
    per_stage = tasks.groupBy(*stage).agg(
        F.count("*").alias("tasks"),
        F.max("duration_ms").alias("longest_ms"),
        F.max_by("task_id", F.struct("duration_ms", "task_id")).alias("slowest_task"),
    )
    # A stage may have any number of distinct durations; they are never held in one buffer.
    medians = exact_percentiles(tasks, stage, "duration_ms", {"median_ms": 0.5})
    per_stage = per_stage.join(medians, stage).select(*stage, "tasks", "longest_ms", "median_ms", "slowest_task")
    worst = F.col("longest_ms") / F.nullif("median_ms", F.lit(0.0))
    return per_stage.select("*", worst.alias("ratio"), F.coalesce(worst > ratio, F.lit(False)).alias("uneven"))


def spill(tasks: DataFrame) -> DataFrame:
    spilled = (F.col("memory_spilled") > 0) | (F.col("disk_spilled") > 0)
    return tasks.groupBy("app", "stage_id").agg(
        F.sum("memory_spilled").alias("memory_spilled"),
        F.sum("disk_spilled").alias("disk_spilled"),
        F.count(F.when(spilled, 1)).alias("spilling_tasks"),
    )


def gc_share(tasks: DataFrame) -> DataFrame:
    """Garbage collection as a share of run time per executor, in the usual bands."""
    summed = tasks.groupBy("app", "executor").agg(F.sum("gc_ms").alias("gc_ms"), F.sum("run_ms").alias("run_ms"))
    share = _ratio(F.col("gc_ms"), F.col("run_ms"))
    band = (
        F.when(share > 0.20, "critical").when(share > 0.10, "warning").when(share < 0.05, "healthy").otherwise("watch")
    )
    return summed.select("*", share.alias("share"), band.alias("band"))


def shuffle_ratio(tasks: DataFrame, limit: float = 10.0) -> DataFrame:
    """Bytes shuffled against bytes read from storage per application."""
    summed = tasks.groupBy("app").agg(
        F.sum("input_bytes").alias("input_bytes"),
        F.sum(F.col("remote_bytes") + F.col("local_bytes")).alias("shuffle_read"),
        F.sum("shuffle_written").alias("shuffle_written"),
    )
    ratio = _ratio(F.col("shuffle_read") + F.col("shuffle_written"), F.col("input_bytes"))
    return summed.select("*", ratio.alias("ratio"), F.coalesce(ratio > limit, F.lit(False)).alias("alert"))


def shuffle_time(tasks: DataFrame, limit: float = 0.5) -> DataFrame:
    """Time spent waiting for and writing shuffle data as a share of run time per stage."""
    summed = tasks.groupBy("app", "stage_id").agg(
        F.sum("fetch_wait_ms").alias("fetch_wait_ms"),
        F.sum("shuffle_write_ns").alias("shuffle_write_ns"),
        F.sum("run_ms").alias("run_ms"),
    )
    share = _ratio(F.col("fetch_wait_ms") * 1_000_000 + F.col("shuffle_write_ns"), F.col("run_ms") * 1_000_000)
    return summed.select("*", share.alias("share"), F.coalesce(share > limit, F.lit(False)).alias("alert"))


def locality(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("app", "locality").agg(
        F.count("*").alias("tasks"), F.sum("remote_bytes").alias("remote_bytes"), F.sum("local_bytes").alias("local_bytes")
    )


def executor_timeline(events: DataFrame) -> DataFrame:
    """Number of executors after each change. Changes at the same moment are summed first."""
    step = F.when(F.col("Event") == "SparkListenerExecutorAdded", 1).when(
        F.col("Event") == "SparkListenerExecutorRemoved", -1
    )
    moved = events.select("app", F.col("Timestamp").alias("at_ms"), step.cast("long").alias("step"))
    changes = moved.where(F.col("step").isNotNull()).groupBy("app", "at_ms").agg(F.sum("step").alias("step"))
    return running(changes, ["app"], ["at_ms"], F.col("step"), "executors").select("app", "at_ms", "executors")


def jobs(events: DataFrame) -> DataFrame:
    """Jobs and stages per application with their total and longest durations."""
    kind = F.col("Event")
    timed = events.where(kind.isin("SparkListenerJobStart", "SparkListenerJobEnd")).select(
        "app",
        F.col("Job ID").alias("job"),
        F.coalesce("Submission Time", "Completion Time").alias("at_ms"),
        F.col("Job Result.Result").alias("result"),
    )
    per_job = timed.groupBy("app", "job").agg(
        (F.max("at_ms") - F.min("at_ms")).alias("ms"), F.max("result").alias("result")
    )
    by_app = per_job.groupBy("app").agg(
        F.count("*").alias("jobs"),
        F.count(F.when(F.col("result") != "JobSucceeded", 1)).alias("failed_jobs"),
        F.sum("ms").alias("job_ms"),
        F.max("ms").alias("longest_job_ms"),
    )
    done = events.where(kind == "SparkListenerStageCompleted").select("app", F.col("Stage Info").alias("s"))
    took = F.col("s").getField("Completion Time") - F.col("s").getField("Submission Time")
    stages = done.groupBy("app").agg(F.count("*").alias("stages"), F.sum(took).alias("stage_ms"))
    return by_app.join(stages, "app", "left").na.fill(0, ["stages", "stage_ms"])


def failures(tasks: DataFrame) -> DataFrame:
    failed = tasks.where(F.col("reason") != "Success")
    return failed.groupBy("app", "reason").agg(
        F.count("*").alias("tasks"), F.count_distinct("stage_id").alias("stages"), F.count_distinct("executor").alias("executors")
    )


def slow_sql(events: DataFrame, at_least_ms: int) -> DataFrame:
    """SQL executions that took at least so long, with their plan. Start and end meet in one grouping."""
    both = events.where(F.col("Event").isin(SQL_START, SQL_END)).groupBy("app", F.col("executionId").alias("execution")).agg(
        F.min(F.when(F.col("Event") == SQL_START, F.col("time"))).alias("start_ms"),
        F.max(F.when(F.col("Event") == SQL_END, F.col("time"))).alias("end_ms"),
        F.max("description").alias("description"),
        F.max("physicalPlanDescription").alias("plan"),
    )
    timed = both.withColumn("duration_ms", F.col("end_ms") - F.col("start_ms"))
    return timed.where(F.col("duration_ms") >= at_least_ms)


def compare_runs(tasks: DataFrame, before: str, after: str, by: Sequence[str] = ("stage_id",)) -> DataFrame:
    """Two applications side by side per stage, as differences of the sums."""
    measures = ["run_ms", "gc_ms", "disk_spilled", "shuffle_written"]
    sums = []
    for m in measures:
        sign = F.when(F.col("app") == after, F.col(m)).otherwise(-F.col(m))
        sums += [F.sum(F.when(F.col("app") == before, F.col(m)).otherwise(0)).alias(f"{m}_before"), F.sum(sign).alias(f"{m}_change")]
    return tasks.where(F.col("app").isin(before, after)).groupBy(*by).agg(*sums)
