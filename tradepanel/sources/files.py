"""What lies in a folder: one row per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Path, size and time of every file; contents are not read, as only the
    metadata columns are selected."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "modificationTime", "length")
    )
    return files.filter(F.col("path").contains(pattern)) if pattern else files


def latest_file(spark: SparkSession, path: str, pattern: str | None = None, suffix=".csv"):
    """The newest file of a kind by time, later path first among equals."""
    files = listing(spark, path, pattern).filter(F.col("path").endswith(suffix))
    newest = F.max_by("path", F.struct("modificationTime", "path"))
    return files.agg(newest.alias("path"), F.max("modificationTime").alias("modified"))


def latest_artifact(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The last by name, as versions in names sort by time."""
    return listing(spark, path, name).agg(F.max("path").alias("path"))


def last_update(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """Time of the newest file and number of rows of each Parquet dataset."""
    result = None
    for name, path in sources.items():
        updated = listing(spark, path).agg(F.max("modificationTime").alias("last_update"))
        rows = spark.read.parquet(path).agg(F.count("*").alias("record_count"))
        one = updated.select(
            F.lit(name).alias("data_source"), "last_update", rows.scalar().alias("record_count")
        )
        result = one if result is None else result.unionByName(one)
    return result
