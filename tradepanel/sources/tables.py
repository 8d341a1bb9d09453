"""Tables and artifacts: reads, writes and guards."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..constants import MIN_TRAINING_ROWS, REFERENCE_REGIONS, REFERENCE_YEAR
from ..functions import cleaning as C
from ..schemas import EXPORT_ANALYTICS
from ..session import new_folder
from . import folders


def clustered(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """Rows dealt out by ranges of a column inside each value of ``by``, and sorted by it.

    A reader who filters by the column then skips most files and row groups of the
    written table. A hash of the row goes into the ranges, so that a value with most of
    the rows is spread over several of them.
    """
    keys = [C.named(name) for name in (by, column) if name is not None]
    return dealt_out(df, *keys).sortWithinPartitions(*keys)


def dealt_out(df: DataFrame, *keys: Column) -> DataFrame:
    """Rows by ranges of the keys and of a hash of the row. All rows are read twice for it,
    as the ranges are sampled first."""
    return df.repartitionByRange(*keys, F.xxhash64(*[C.named(name) for name in df.columns]))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by: str | None = None, even: bool = True) -> str:
    """Parquet, partitioned by a column where one is given.

    The rebalance before a partitioned write gives files of even size: it merges
    small pieces of a year and splits a year that holds most of the rows. Rows that are
    ``clustered`` already go without it (``even`` false).
    """
    if by is None:
        df.write.mode(mode).parquet(path)
    else:
        (df.hint("rebalance", by) if even else df).write.mode(mode).partitionBy(by).parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of ours, with its own schema."""
    return spark.read.parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the workspace and go on from there.

    For results that are read several times: the plan before it is run once, and
    a lost executor costs a read of a file, not that plan.
    """
    spark = df.sparkSession
    return read_table(spark, write_table(df, new_folder(spark, name)))


def write_csv(df: DataFrame, path: str, single_file: bool = False, encoding: str = "UTF-8") -> str:
    """CSV with a header. One file only on request, for small marts."""
    if single_file:
        df = df.repartition(1)
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("escape", '"')
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
    return path


def snapshot_path(path: str, at: datetime) -> str:
    return f"{path}/snapshot_id={at:%Y%m%d_%H%M%S}"


def write_snapshot(df: DataFrame, path: str, at: datetime) -> str:
    """A copy under the time of the run; earlier ones stay."""
    return write_table(df, snapshot_path(path, at), mode="errorifexists")


def append_table(df: DataFrame, path: str) -> str:
    """Add rows to a Parquet table."""
    return write_table(df, path, mode="append")


def append_jdbc(df: DataFrame, url: str, table: str, batch: int = 1000, **options) -> None:
    """Add rows to a database table in batches."""
    writer = df.write.format("jdbc").mode("append").options(url=url, dbtable=table, **options)
    writer.option("batchsize", batch).save()


def read_jdbc(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """A database query; name a partition column and bounds to read in parallel."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def scan_sql(spark: SparkSession, query: str, **views: DataFrame) -> DataFrame:
    """SQL over named DataFrames."""
    return spark.sql(query, **views)


def replace_partitions(df: DataFrame, path: str, by: str = "year") -> str:
    """Replace the partitions that occur in the new rows, keep the others.
    Running it twice changes nothing."""
    (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )
    return path


def has_rows(df: DataFrame, at_least: int = 1) -> bool:
    """Whether there are so many rows; stops reading once there are."""
    if at_least <= 1:
        return not df.isEmpty()
    return df.limit(at_least).count() >= at_least


def require_rows(df: DataFrame, at_least: int = MIN_TRAINING_ROWS) -> DataFrame:
    """The same DataFrame, or an error."""
    if not has_rows(df, at_least):
        raise ValueError(f"fewer than {at_least} rows")
    return df


def observed_write(df: DataFrame, path: str, by: str | None = None, even: bool = True, **measures: Column) -> dict:
    """Write a table and return measures of its rows, counted by the write itself."""
    seen = Observation()
    observed = df.observe(seen, *[value.alias(name) for name, value in measures.items()])
    write_table(observed, path, by=by, even=even)
    return seen.get


def write_if_any(df: DataFrame, path: str) -> bool:
    """Write a mart and report whether it has rows. The mart is run and written once,
    beside its place, and put there if it has rows; an empty one leaves what was there."""
    spark = df.sparkSession
    beside = f"{path}-{uuid.uuid4().hex}"
    if observed_write(df, beside, rows=F.count(F.lit(1)))["rows"] == 0:
        folders.remove(spark, beside)
        return False
    folders.publish(spark, beside, path)
    return True


def seed_reference_regions(analytics: DataFrame) -> DataFrame:
    """The reference regions that the table does not hold yet, added."""
    spark = analytics.sparkSession
    key = ["analysis_type", "region", "year"]
    seeds = spark.createDataFrame(
        [
            ("regional_reference", REFERENCE_YEAR, None, region, None, None, 0.0, 0, None, None, None)
            for region in REFERENCE_REGIONS
        ],
        EXPORT_ANALYTICS,
    )
    present = analytics.filter(F.col("analysis_type") == "regional_reference").select(*key)
    return analytics.unionByName(seeds.join(present, key, "left_anti"))


def write_json(df: DataFrame, path: str) -> str:
    """S21."""
    df.write.mode("errorifexists").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """S21."""
    return spark.read.schema(schema).json(path)
