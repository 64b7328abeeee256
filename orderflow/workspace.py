"""Shared folder for checkpoints, written intermediate tables and stream state."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing = threading.Lock()
#: Writes under way, and what the session said before the first of them.
_writes: list[str | None] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: driver and
    executors are one process there.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(_CONF, None) or sc.getConf().get(_CONF) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError(f"set {_CONF} to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="orderflow-"))
    return sc.getCheckpointDir().rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; never handed out twice."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes and queries inside are deleted when each of them ends.

    Otherwise they stay until the driver happens to collect its garbage, and those of
    one after another add up. A write plans anew, so nothing else reads them; a table
    that is collected inside would be shuffled again if it were collected once more.
    """
    with _writing:
        _writes.append(_writes[0] if _writes else spark.conf.get(_CLEANUP, None))
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _writing:
            before = _writes.pop()
            if not _writes:
                if before is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, before)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write `df` to the shared folder once and read it back.

    Cuts the lineage in a way that survives executor loss, and gives the
    readers Parquet statistics and partition pruning.
    """
    spark = df.sparkSession
    path = run_dir(spark, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    with shuffles_freed(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
