"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import suppress
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"


# Runtime settings the library relies on: AQE, with its skew-join split also where an
# operator after the join would otherwise reuse the join's partitioning, and with hash
# joins in place of sorts once all partitions of a side turn out small.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64mb",
    # Streaming state outside the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def settle(spark: SparkSession) -> SparkSession:
    """Applies the runtime settings to a session built elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **RUNTIME,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_dir() -> str:
    """A folder of this process, gone with it."""
    path = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the session names it.

    That is the checkpoint folder or else the warehouse. Only where executors are
    threads of this process may it be a folder of the process's own.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] == "local":
        return _own_dir()
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@cache
def _staged_paths() -> list:
    """Paths to delete when the process ends, each with a session to delete it by."""
    paths: list = []

    def clear() -> None:
        for spark, path in paths:
            with suppress(Exception):  # the session may be gone
                _delete(spark, path)

    atexit.register(clear)
    return paths


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def remember(spark: SparkSession, path: str) -> None:
    """Has a folder deleted when the process ends."""
    _staged_paths().append((spark, path))


def forget(spark: SparkSession, path: str) -> None:
    """Deletes a remembered folder now."""
    _delete(spark, path)
    _staged_paths()[:] = [kept for kept in _staged_paths() if kept[1] != path]


def stage(df: DataFrame, label: str = "staged") -> DataFrame:
    """The frame written as Parquet to the shared folder and read back.

    Cuts the lineage of a frame that is read more than once: readers take only the
    columns they need, all see the same rows, and a lost executor costs only the tasks
    that it ran. Frames with columns that Parquet has no type for are checkpointed.
    """
    spark = df.sparkSession
    if any(f.dataType == T.NullType() for f in df.schema):
        context = spark.sparkContext
        if context._jsc.sc().getCheckpointDir().isEmpty():
            context.setCheckpointDir(shared_dir(spark))
        return df.checkpoint()
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    remember(spark, path)
    return spark.read.schema(df.schema).parquet(path)
