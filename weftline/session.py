"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

PARTITION_BYTES = 128 << 20

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def partitions_for(input_bytes: int, at_least: int = 200) -> int:
    """Shuffle partitions that hold about 128 MB each if a whole input is shuffled; adaptive execution merges small ones."""
    return max(at_least, -(-input_bytes // PARTITION_BYTES))


def build_session(
    app: str = "weftline", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with this package on its workers. ``input_bytes`` sizes the shuffles; explicit settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {"spark.sql.shuffle.partitions": str(partitions_for(input_bytes))} if input_bytes else {}
    for key, value in {**DEFAULTS, **sized, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers once per application, so that functions of its modules can run there.

    The archive is a file of the driver, which Spark serves to the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="weftline-package-")
    context.addPyFile(shutil.make_archive(f"{folder}/{here.name}", "zip", here.parent, here.name))
    _shipped.add(context.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own: on a
    cluster a machine-local folder is lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_roots.setdefault(context.applicationId, tempfile.mkdtemp(prefix="weftline-"))
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A new path under the shared folder; nothing else ever writes to it. ``keep`` takes it out of any scratch scope."""
    path = f"{scratch_root(spark)}/weftline/{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None and not keep:
        scope.append(path)
    return path


# Per thread: what a stream's callback writes is not part of a scope that another thread has open.
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what the block wrote to the shared folder once the block is over.

    Results that read those files have to be written or collected inside it. Tables in the scratch database go with
    ``drop_scratch_database``.
    """
    written: list[str] = []
    outer = _scope.set(written)
    try:
        yield
    finally:
        _scope.reset(outer)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in written:
            place = hadoop(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def drop_scratch_database(spark: SparkSession) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {_database_name(spark)} CASCADE")


def _database_name(spark: SparkSession) -> str:
    return "weftline_" + "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId)


def scratch_database(spark: SparkSession) -> str:
    """One database per application, its tables stored under the shared folder."""
    name = _database_name(spark)
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{scratch(spark, 'db', keep=True)}'")
    return name


def scratch_table(spark: SparkSession, label: str) -> str:
    return f"{scratch_database(spark)}.{label}_{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: short lineage, survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
