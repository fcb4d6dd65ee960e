"""Sinks that give each row once, also after a restart."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from weftline.operators.reuse import persisted

BATCH = "_batch"


def sink(sdf: DataFrame, path: str, checkpoint: str, by: Sequence[str] = ()) -> StreamingQuery:
    """Append to parquet files. The sink's log makes a file visible once, whatever is repeated."""
    writer = sdf.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if by:
        writer = writer.partitionBy(*by)
    return writer.option("checkpointLocation", checkpoint).start(path)


def each_batch(
    sdf: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    writer = sdf.writeStream.foreachBatch(write).outputMode(mode).trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start()


def batch_sink(sdf: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """One folder per micro-batch, replaced as a whole when the batch is run again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return each_batch(sdf, write, checkpoint, mode)


def upsert_sink(
    sdf: DataFrame, path: str, key: Sequence[str], seq: Sequence[str], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Newest row per key. A micro-batch writes only the keys it touches; see ``read_upserts``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rest = [c for c in batch.columns if c not in key]
        newest = batch.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*seq)).alias("_row"))
        newest.select(*key, "_row.*").write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return each_batch(sdf, write, checkpoint, mode)


def read_upserts(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """The current row of each key: the one from its latest micro-batch."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in (*key, BATCH)]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), BATCH).alias("_row")).select(*key, "_row.*")


def compact_upserts(spark: SparkSession, path: str, target: str, key: Sequence[str]) -> None:
    """Write the current rows to a new folder as batch -1, from which a fresh log can go on."""
    read_upserts(spark, path, key).write.parquet(f"{target}/{BATCH}=-1")


def quarantine_sink(
    sdf: DataFrame, split: Callable[[DataFrame], tuple[DataFrame, DataFrame]], good: str, bad: str, checkpoint: str
) -> StreamingQuery:
    """Good and bad rows to two tables; both folders of a batch are replaced when it is run again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with persisted(batch) as kept:  # else the batch would be computed once per table
            for rows, path in zip(split(kept), (good, bad)):
                rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return each_batch(sdf, write, checkpoint)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait until the query has read all that is there; an error in the stream is raised here."""
    query.awaitTermination()
    return query


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows that state operators refused as late. Counted after partial aggregation, so a lower bound."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def late_report(received: DataFrame, accepted: DataFrame, keys: Sequence[str], n: str = "n") -> DataFrame:
    """Rows that arrived, were counted, and came too late, per group."""
    counted = accepted.select(*keys, F.col(n).alias("accepted"))
    known = F.coalesce("accepted", F.lit(0))
    joined = received.select(*keys, F.col(n).alias("received")).join(counted, list(keys), "left")
    return joined.select(*keys, "received", known.alias("accepted"), (F.col("received") - known).alias("late"))
