"""Session construction and shared scratch space.

On a cluster the shared folder comes from ``spark.checkpoint.dir``; it is only
set here when the session has none (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "stratiform",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, driver_memory: str | None = "8g") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory and master and master.startswith("local"):
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def active_session() -> SparkSession:
    """The session of this thread, or the process-wide one: PySpark's active
    session is thread-local, and work submitted from driver threads (fold
    preparation, parallel fits) must still find it."""
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(_CHECKPOINT_KEY, None) \
        or sc.getConf().get(_CHECKPOINT_KEY, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder")
    path = tempfile.mkdtemp(prefix="stratiform-ckpt-")
    sc.setCheckpointDir(path)
    spark.conf.set(_CHECKPOINT_KEY, path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    # checkpoint dirs set through SparkContext get a per-application subfolder
    return os.path.join(base.rstrip("/"), "scratch", f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back: the
    lineage ends there, and lost executors lose nothing of it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``materialise``d table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Largest Arrow batch sent to a Python worker where rows are packed blocks.
ARROW_BYTES = 16 << 20
_ARROW_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_arrow(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to ``ARROW_BYTES``; a smaller setting stays."""
    held = spark.conf.get(_ARROW_KEY, None)
    if held is None or not held.isdigit() or not 0 < int(held) <= ARROW_BYTES:
        spark.conf.set(_ARROW_KEY, str(ARROW_BYTES))


_scopes: list[list[DataFrame]] = []
_scopes_lock = threading.Lock()


def cached(df: DataFrame) -> DataFrame:
    """``df`` persisted; released when the outermost ``caches_released`` ends, whatever
    thread asked for it. Without a scope it stays until the session clears its cache."""
    if df.is_cached:
        return df
    df = df.persist()
    with _scopes_lock:
        if _scopes:
            _scopes[0].append(df)
    return df


@contextmanager
def caches_released():
    """Release what ``cached`` keeps inside. Frames that are used later are computed
    anew, so results that leave the scope should be stored or small."""
    mine: list[DataFrame] = []
    with _scopes_lock:
        _scopes.append(mine)
    try:
        yield
    finally:
        with _scopes_lock:
            _scopes[:] = [s for s in _scopes if s is not mine]
        for df in mine:
            df.unpersist()
