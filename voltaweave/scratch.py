"""Folders that driver and executors share, for checkpoints and tables between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one in ``spark.checkpoint.dir``; only a session of one process may do without that setting."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="voltaweave-"))
        found = sc.getCheckpointDir()
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _filesystem(spark: SparkSession, path: str):
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _filesystem(spark, path)
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark reads it; one that isn't there is no error."""
    files, where = _filesystem(spark, path)
    files.delete(where, True)
