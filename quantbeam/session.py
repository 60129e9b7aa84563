"""Session construction and cluster-safe settings."""

from __future__ import annotations

import atexit
import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. Shuffle partition count is left to the caller
# (cluster default) except in local runs; AQE coalesces small partitions and
# splits skewed ones at runtime.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Runtime broadcast: AQE converts a join to broadcast only when the
    # materialised shuffle output of one side is measured below this size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Streaming state (latest tick per symbol) off-heap with incremental checkpoints.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "quantbeam",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a running session
                pass
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name shared storage and is only read: a
    session without it is refused, since a folder of one machine would lose
    the other machines' files. A private scratch folder is created solely for
    a ``local`` master (tests).
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="quantbeam-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


# Folders written for intermediate results, by application and thread:
# streams run side by side, and each owns what it wrote.
_SCRATCH: dict[str, dict[int, list[str]]] = {}


def _own(spark: SparkSession) -> list[str]:
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = {}
        atexit.register(_release_all, spark, app)
    return _SCRATCH[app].setdefault(threading.get_ident(), [])


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder under the shared checkpoint folder. ``release`` deletes
    it; the end of the driver does so at the latest."""
    path = os.path.join(checkpoint_dir(spark), "tables", f"{label}-{uuid.uuid4().hex}")
    _own(spark).append(path)
    return path


def mark(spark: SparkSession) -> int:
    """How many scratch folders this thread has, for a later ``release``."""
    return len(_own(spark))


def release(spark: SparkSession, since: int = 0) -> int:
    """Delete this thread's scratch folders made after ``mark`` returned
    ``since``. Call it once the results that read them have been written."""
    paths = _own(spark)[since:]
    for path in paths:
        delete_path(spark, path)
    del _own(spark)[since:]
    return len(paths)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that Spark uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _release_all(spark: SparkSession, app: str) -> None:
    try:
        for path in [p for paths in _SCRATCH.pop(app, {}).values() for p in paths]:
            delete_path(spark, path)
    except Exception:  # the JVM has gone already: nothing left to ask
        pass


#: Bytes of whole texts that a Python task is handed at once.
TEXT_BATCH = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_LOCK = threading.Lock()


@contextmanager
def arrow_batches(spark: SparkSession, most: int):
    """Jobs that run meanwhile hand Python tasks Arrow batches of about ``most``
    bytes, or one row. The JVM and the worker each hold a batch and its copies,
    which go with the texts' lengths if rows alone are counted."""
    with _BATCH_LOCK:
        before = spark.conf.get(_BATCH_BYTES)
        spark.conf.set(_BATCH_BYTES, str(most))
        try:
            yield
        finally:
            spark.conf.set(_BATCH_BYTES, before)


def materialize(df, label: str = "stage", partition_by: str | None = None, compression: str | None = None,
                batch_bytes: int | None = None):
    """Cut lineage by writing ``df`` once as Parquet under the shared
    checkpoint folder and reading it back. Consumers then share one
    computation, a lost executor does not replay the upstream plan, and the
    planner sees the real (file-size) statistics of the result, so AQE can
    broadcast it only when it is measurably small. (An RDD checkpoint
    would compute the plan twice.) ``batch_bytes`` bounds the Arrow batches of
    its Python steps."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    w = df.write
    if partition_by:
        w = w.partitionBy(partition_by)
    if compression:
        w = w.option("compression", compression)
    if batch_bytes:
        with arrow_batches(spark, batch_bytes):
            w.parquet(path)
    else:
        w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
