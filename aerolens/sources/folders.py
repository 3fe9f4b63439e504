"""Folders in whatever file system Spark reads: look up, list, remove."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _located(spark, path)
    return system.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all that is in it; nothing happens if there is none."""
    system, folder = _located(spark, path)
    system.delete(folder, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern such as ``table/*/batch_id=7``."""
    system, folder = _located(spark, pattern)
    return [str(status.getPath()) for status in system.globStatus(folder) or []]


def modified(spark: SparkSession, path: str) -> float:
    """When a file was written, in seconds; 0 if it is gone."""
    system, file = _located(spark, path)
    return system.getFileStatus(file).getModificationTime() / 1000 if system.exists(file) else 0.0


def remove_if_empty(spark: SparkSession, path: str) -> None:
    system, folder = _located(spark, path)
    if system.exists(folder) and len(system.listStatus(folder)) == 0:
        system.delete(folder, False)
