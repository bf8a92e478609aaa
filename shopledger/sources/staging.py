"""Intermediate tables on shared storage.

A result that several outputs read is written once as Parquet and read back.
Unlike a cache it survives lost executors, and each reader scans only the
columns it needs.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def staging_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Without that setting a local session (tests) gets a temporary folder; a
    cluster gets an error, because its machines share no local folder. What is left
    of the folder when the application ends is deleted then.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="shopledger-")
    else:
        folder = f"{root.rstrip('/')}/shopledger-{uuid4().hex}"
    path, files = file_system(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written to ``folder/name`` and read back."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, folder: str) -> None:
    """Deletes a folder made by ``staging_folder``."""
    path, files = file_system(spark, folder)
    files.delete(path, True)
    files.cancelDeleteOnExit(path)


def file_system(spark: SparkSession, folder: str):
    """(path, file system) of a folder, as the cluster's configuration has it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())
