"""Stream input: file source, event time, and files laid down in time order."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from weftline.session import scratch

ROWS_PER_FILE = 2_000_000
#: Size of the row groups of a landed file. A row group is read by one task, so a file in a single one would be.
ROW_GROUP_BYTES = 4 << 20


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with settings for stateful queries.

    State lives in RocksDB, on disk with a bounded cache, so it may outgrow memory.
    The number of state partitions is fixed for the life of a checkpoint and follows
    the size of the cluster. Sessions are merged before the shuffle.
    """
    session = spark.newSession()
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(max(8, spark.sparkContext.defaultParallelism)),
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        # One store per partition holds both sides of a join.
        "spark.sql.streaming.join.stateFormatVersion": "3",
        # Changes are uploaded per batch instead of whole snapshots.
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def stream(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None, max_bytes: str | None = None
) -> DataFrame:
    """Parquet files as a stream. ``max_files`` and ``max_bytes`` limit the intake of one micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a timestamp with a zone; zoneless values are read in the session's."""
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps back to zoneless values, for a sink."""
    changed = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.withColumns(changed) if changed else df


def land_in_order(df: DataFrame, ts: str, path: str, at_least: int = 4, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``df`` as files whose age rises with event time, each of ``rows_per_file`` rows or less.

    A stream that takes one file at a time then gets micro-batches in time order whose size does not follow the table. Cuts are
    at full minutes, found from the rows per minute. Rows without a time come first. They, or one minute, may be more than a
    file holds; they are then dealt to several files, whose order within the minute is open.

    The table is read twice, however many files there are: once for the counts, once to deal the rows to bins.
    """
    minute = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / 60)
    counted = df.groupBy(minute.alias("minute")).agg(F.count("*").alias("n")).orderBy(F.asc_nulls_first("minute"))
    sizes, minutes, total = [], [], 0
    for row in counted.collect():  # one row per minute of the calendar
        minutes.append((row["minute"], row["n"]))
        total += row["n"]
    wanted, bins = math.ceil(total / max(at_least, math.ceil(total / rows_per_file))), []
    for at, n in minutes:
        if not sizes or sizes[-1] and sizes[-1] + n > wanted:
            sizes.append(0)
        sizes[-1] += n
        bins.append((at, len(sizes) - 1))
    if not sizes:
        df.write.mode("append").parquet(path)
        return
    files = [max(1, math.ceil(size / rows_per_file)) for size in sizes]
    spark = df.sparkSession
    places = spark.createDataFrame([(at, k, files[k]) for at, k in bins], "_minute long, _bin int, _files int")
    placed = df.withColumn("_at", minute).join(places, F.col("_at").eqNullSafe(F.col("_minute"))).drop("_at", "_minute")
    # One pass deals all rows to their bins; each bin is then handed over by itself, so that its files are younger than those before.
    staged = scratch(spark, "landing-bins")
    dealt = placed.repartition(sum(files), "_bin", F.pmod(F.xxhash64(*df.columns), F.col("_files"))).drop("_files")
    dealt.write.option("maxRecordsPerFile", rows_per_file).partitionBy("_bin").parquet(staged)
    for k, n in enumerate(files):
        rows = spark.read.schema(df.schema).parquet(f"{staged}/_bin={k}")
        writer = rows.repartition(n).write.mode("append").option("maxRecordsPerFile", rows_per_file)
        writer.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
