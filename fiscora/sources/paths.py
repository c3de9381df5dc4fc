"""File-system look-ups through Hadoop, so that they work on any store Spark can read."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """``(path, file system)`` of a folder."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = hadoop_path(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if it does not exist."""
    target, fs = hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; nothing happens if there is none."""
    target, fs = hadoop_path(spark, path)
    fs.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    """Leave an empty file, with the folders above it."""
    target, fs = hadoop_path(spark, path)
    fs.create(target, True).close()
