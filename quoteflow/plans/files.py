"""Folders in whatever file system a path names, looked at and deleted through Spark's own access to it.

Spark's public Python functions read and write data but neither list nor delete folders, so this goes by the
session's JVM, which a Spark Connect session doesn't have.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    files, path = _at(spark, folder)
    return files.exists(path)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names of what lies in a folder; none if there is no such folder."""
    files, path = _at(spark, folder)
    return sorted(entry.getPath().getName() for entry in files.listStatus(path)) if files.exists(path) else []


def delete(spark: SparkSession, folder: str) -> bool:
    """Delete a folder with all in it; whether there was one."""
    files, path = _at(spark, folder)
    return files.delete(path, True)


def delete_others(spark: SparkSession, folder: str, keep: set[str]) -> int:
    """Delete what lies in a folder but for the names to keep; how many went."""
    return sum(delete(spark, f"{folder}/{name}") for name in names(spark, folder) if name not in keep)
