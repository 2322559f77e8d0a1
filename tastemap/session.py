"""Session construction and the shared folder used for lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  Shuffle partitions and the broadcast
# threshold are cluster sizing knobs, so callers may override them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE merges partitions but splits only joins: start with many.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tastemap", extra: dict | None = None) -> SparkSession:
    """A session with the defaults above.  Master, shuffle partitions and heap
    stay as submitted unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if os.environ.get("TASTEMAP_DRIVER_MEMORY"):
        conf["spark.driver.memory"] = os.environ["TASTEMAP_DRIVER_MEMORY"]
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediates.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system), and
    its absence is an error.  Only in local mode, when the session names
    none (as in tests), a fresh local folder is taken.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               "(a shared file system); a machine-local folder does not survive "
                               "on a cluster")
        configured = tempfile.mkdtemp(prefix="tastemap-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the checkpoint folder for a written table."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    for paths in _scopes:
        paths.append(path)
    return path


_scopes: list[list[str]] = []


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder through the file system that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Tables written below ``scratch_path`` inside go at the end: for jobs
    whose results are written elsewhere, not for lazy results."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes[:] = [s for s in _scopes if s is not paths]
        for path in paths:
            delete_path(spark, path)


SPENT_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def spent_shuffles_removed(spark: SparkSession):
    """Shuffle files of queries run inside go when the query ends: for tables that are
    written and read back, whose shuffles no later job reads.  Otherwise they stay
    until the driver happens to collect its garbage."""
    before = spark.conf.get(SPENT_SHUFFLES, None)
    spark.conf.set(SPENT_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(SPENT_SHUFFLES) if before is None else spark.conf.set(SPENT_SHUFFLES, before)


# Frames persisted by operators that must read one materialized copy twice
# (size checks, partition counts).  Jobs release them once their output is
# written.
_held: list[DataFrame] = []


def hold(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Persist ``df`` and remember it for ``release_held``.

    A persisted block lost with its executor is rebuilt from lineage, so
    this is safe where local checkpoints are not.
    """
    df = df.persist(level)
    _held.append(df)
    return df


def release_held() -> None:
    while _held:
        _held.pop().unpersist()
