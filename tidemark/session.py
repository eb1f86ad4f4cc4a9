"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split of a hot join key is worth the extra shuffle that may follow it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Merge the sessions of one key inside each map task first, so a hot path ships few rows.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # Lists of chunk ids reach row group statistics and bloom filters one by one, not as one wide range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC times; `extra` uses `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    A machine-local folder stands in only on a local master with the setting missing.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Removes a folder that this library wrote, on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result is read from shared storage, so lost executors cannot change it."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a command go as it ends, not when the driver happens to collect its garbage.

    A frame that runs a second time computes its shuffles again. Those of cached frames stay as long as before.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows hashed over all cores where the scan of `df` has fewer tasks than there are cores.

    A table of a few large row groups is read by a few tasks, which then carry all the work per row.
    A large table is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
