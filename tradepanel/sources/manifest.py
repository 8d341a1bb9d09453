"""Which landed files have been loaded: incremental loads by source file.

The manifest has one row per file and load, written after the rows themselves. It alone
says what a table holds, so a run that ends half-way leaves nothing behind that is seen,
and running it again replaces what it has written.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .export_files import inspect_files
from .folders import exists
from .tables import stored, write_table

MANIFEST = (
    "LOAD string, file string, size bigint, modified timestamp, content string, lines bigint, "
    "status string, reason string"
)
LOADED, REPEATED, REFUSED = "loaded", "repeated", "refused"


def load_id(run_at: datetime) -> str:
    return f"{run_at:%Y%m%dT%H%M%S}"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return entries(spark.read.schema(MANIFEST).parquet(path))


def changed_files(listed: DataFrame, manifest: DataFrame) -> DataFrame:
    """Listed files that no load has met with this size and time. None is read for this."""
    known = manifest.select("file", "size", "modified")
    return listed.join(known, ["file", "size", "modified"], "left_anti")


def inspect_changes(spark: SparkSession, fresh: DataFrame, earlier: DataFrame, load: str) -> DataFrame:
    """The new manifest rows of a load, with what ``inspect_files`` found; stored.

    ``fresh`` are the files to look at: only these are read. A file with the content of
    one that was loaded before, or of another one (by path) in this load, is a repeat: a
    copy is loaded once.
    """
    fresh = stored(fresh.select("file", "size", "modified"), "fresh-files")
    paths = [row.file for row in fresh.select("file").toLocalIterator()]
    seen = inspect_files(spark, files=paths)
    found = fresh.join(seen, "file")
    known = earlier.where(F.col("status") == LOADED).select("content").distinct().withColumn("known", F.lit(True))
    copies = Window.partitionBy("content", "valid").orderBy("file")
    found = found.join(known, "content", "left").withColumn("copy", F.row_number().over(copies))
    repeated = F.col("known").isNotNull() | (F.col("copy") > 1)
    status = F.when(~F.col("valid"), REFUSED).when(repeated, REPEATED).otherwise(LOADED)
    return stored(found.withColumns({"LOAD": F.lit(load), "status": status}).drop("known", "copy"), "changes")


def entries(changes: DataFrame) -> DataFrame:
    return changes.select(*[field.split()[0] for field in MANIFEST.split(", ")])


def write_load(rows: DataFrame, path: str, load: str, by: str | None = None) -> None:
    """The rows of one load, in its own folder of the table. What an earlier run of the
    same load has left there is replaced."""
    write_table(rows.drop("LOAD"), f"{path}/LOAD={load}", by=by)


def commit(changes: DataFrame, path: str, load: str) -> None:
    """Write the manifest rows of a load; from now on its rows count."""
    write_load(entries(changes).coalesce(1), path, load)


def superseded(manifest: DataFrame) -> DataFrame:
    """(LOAD, SOURCE_PATH): loads of files of which a later load has other content."""
    last = Window.partitionBy("file").orderBy(F.desc("LOAD"))
    loads = manifest.where(F.col("status") == LOADED).withColumn("newest", F.row_number().over(last))
    return loads.where("newest > 1").select("LOAD", F.col("file").alias("SOURCE_PATH"))


def current_rows(table: DataFrame, manifest: DataFrame) -> DataFrame:
    """The rows of finished loads, of a file those of its last one.

    Loads are a short list, and pushed down to their partitions. Corrected files are few;
    without any the rows are not joined.
    """
    loads = [row.LOAD for row in manifest.where(F.col("status") == LOADED).select("LOAD").distinct().collect()]
    rows = table.where(F.col("LOAD").isin(loads))
    gone = stored(superseded(manifest), "superseded")
    return rows if gone.isEmpty() else rows.join(gone, ["LOAD", "SOURCE_PATH"], "left_anti").select(table.columns)


def current_table(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """``current_rows`` of a table; loads may differ in their columns."""
    return current_rows(spark.read.option("mergeSchema", "true").parquet(path), manifest)
