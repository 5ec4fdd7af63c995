"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# What the jobs here rely on.  Sizing (executors, shuffle partitions, memory) is
# left to the cluster; adaptive execution coalesces from whatever it sets.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    # split a skewed join even where a later step then needs a shuffle of its own
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def build_session(app_name: str = "waybill", master: str | None = None, **conf) -> SparkSession:
    """A session with SETTINGS; ``conf`` keys use ``__`` for dots and win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master, where driver and executors share one disk, gets a
    temporary folder when the setting is absent.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    chosen = context.getCheckpointDir()
    if chosen:
        return chosen
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="waybill-checkpoint-"))
    return context.getCheckpointDir()


def temporary_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one; it is deleted when the application ends."""
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    if getattr(_HERE, "folders", None) is not None:
        _HERE.folders.append(folder)
    return folder


_HERE = threading.local()


@contextlib.contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Temporary folders made inside, by this thread, go at the end: for the batches of
    a stream, which outlive no batch but would fill the disk over days."""
    outer = getattr(_HERE, "folders", None)
    _HERE.folders = []
    try:
        yield
    finally:
        for folder in _HERE.folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            files = path.getFileSystem(spark._jsc.hadoopConfiguration())
            files.delete(path, True)
            files.cancelDeleteOnExit(path)
        _HERE.folders = outer


def materialise(df):
    """Write ``df`` to the shared folder and go on from there, without its lineage.

    Runs the job at once.  As stored files the rows have a known size.
    """
    folder = temporary_folder(df.sparkSession, "table")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def size_in_bytes(df) -> int:
    """The optimizer's estimate; for stored files, their size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
