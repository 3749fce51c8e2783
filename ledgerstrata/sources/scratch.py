"""Shared scratch storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode without it.

    On a cluster a machine-local folder would be lost with its machine, so the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = configured or spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="ledgerstrata-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


# Paths handed out in this process.
_handed_out: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def drop_scratch(spark: SparkSession, path: str) -> bool:
    """Delete one path that ``scratch_path`` gave and that nothing reads any more."""
    _handed_out.remove(path)
    return _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True))


def remove_scratch(spark: SparkSession) -> int:
    """Delete what was written to scratch paths of this process; the number of folders deleted.

    DataFrames that read them, or checkpoints made from them, must not be used any more. Checkpoints
    are deleted by Spark itself where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    deleted = 0
    while _handed_out:
        deleted += _delete(spark, _handed_out.pop())
    return deleted


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later plans read the stored rows instead of computing them again."""
    spark = df.sparkSession
    root = scratch_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint()
