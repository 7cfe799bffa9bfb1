"""Session settings the engine relies on, and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Folders of materialized tables that are still there.
_WRITTEN: list[str] = []
# Those of the thread's own ``scratch`` block, if it is in one.
_OWN = threading.local()

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: int = 8, app: str = "docfold") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings the engine relies on.

    Instants are read and written in UTC, and a skewed join is split even when that costs a shuffle.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared checkpoint folder the cluster names.

    Only a local-mode session without that setting gets a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="docfold-")
    return os.path.join(base, "docfold", f"{purpose}-{uuid.uuid4().hex}")


def materialize(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame that several later steps read, and read it back.

    This cuts the lineage with a table in the shared folder: the work is done once, later readers
    prune columns and push filters, and their plans know the size. ``discard_work`` removes it.
    """
    spark = frame.sparkSession
    folder = work_folder(spark, purpose)
    frame.write.parquet(folder)
    getattr(_OWN, "written", _WRITTEN).append(folder)
    return spark.read.schema(frame.schema).parquet(folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables this thread materializes in the block are removed at its end: a query that never ends leaves none."""
    _OWN.written = written = []
    try:
        yield
    finally:
        del _OWN.written
        _remove(spark, written)


def discard_work(spark: SparkSession) -> int:
    """Remove the tables this process has materialized; call it once their results are stored.

    Frames that still read them can't be used any more. Returns the number of folders.
    """
    return _remove(spark, _WRITTEN)


def _remove(spark: SparkSession, folders: list[str]) -> int:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    while folders:
        path = jvm.org.apache.hadoop.fs.Path(folders.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed
