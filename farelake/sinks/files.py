"""Small steps on directories of any file system Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or directory of this name."""
    found, store = _located(spark, path)
    return store.exists(found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory with all it holds, or nothing where there is none."""
    found, store = _located(spark, path)
    store.delete(found, True)
