"""Folders of a store, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, store = _at(spark, path)
    return store.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    where, store = _at(spark, path)
    store.delete(where, True)


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Put a folder that was written beside a table into its place."""
    source, store = _at(spark, written)
    target, _ = _at(spark, path)
    store.delete(target, True)
    if not store.rename(source, target):
        raise OSError(f"{written} could not be renamed to {path}")
