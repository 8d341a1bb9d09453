"""GDP records from landed response pages."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ENOUGH_RECORDS_PER_YEAR
from ..operators.panel import project_records, valid_records
from ..schemas import GDP_RECORDS
from .export_files import readable_path
from .tables import has_rows, stored


def read_records(spark: SparkSession, path, *page_columns: Column) -> DataFrame:
    """The records of pages of the form ``[meta, [record, ...]]``.

    A page is one file of at most some hundred records, so it is read whole. A
    page without a list of records gives no rows.
    """
    pages = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path)
    records = F.from_json(F.get_json_object("value", "$[1]"), GDP_RECORDS)
    return pages.select(*page_columns, F.inline(records))


def read_gdp(spark: SparkSession, path) -> DataFrame:
    """Valid records as flat rows."""
    return project_records(valid_records(read_records(spark, path)))


KEY = ("country_code", "indicator_code", "year")


def read_with_page(spark: SparkSession, path) -> DataFrame:
    """Valid records as flat rows, with the time and the path of their page."""
    file = F.struct("_metadata.file_modification_time", "_metadata.file_path")
    return project_records(valid_records(read_records(spark, path, file.alias("page"))), "page")


def newest_records(flat: DataFrame) -> DataFrame:
    """One record per country, indicator and year: that of the newest page; the
    path and then the values decide between pages of one time."""
    others = [name for name in flat.columns if name not in KEY and name != "page"]
    newest = flat.groupBy(*KEY).agg(F.max(F.struct("page", *others)).alias("newest"))
    return newest.select(*KEY, *[f"newest.{name}" for name in others]).select(*flat.drop("page").columns)


def read_newest_gdp(spark: SparkSession, path) -> DataFrame:
    """Valid records, of a year that was fetched several times the newest."""
    return newest_records(read_with_page(spark, path))


def pages_by_year(spark: SparkSession, path: str) -> dict[int | None, list[str]]:
    """The pages below a path by the year that the name of a folder or file gives, the
    last one in it. Only names are read; there is a handful of pages a year."""
    pages = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    names = pages.select(F.col("_metadata.file_path").alias("file"))
    found: dict[int | None, list[str]] = {}
    for row in names.orderBy("file").collect():
        years = re.findall(r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])", unquote(row.file.removeprefix(path).rsplit(":", 1)[-1])[-200:])
        found.setdefault(int(years[-1]) if years else None, []).append(readable_path(row.file))
    return found


def read_until_enough(spark: SparkSession, path: str, enough: int = ENOUGH_RECORDS_PER_YEAR) -> DataFrame:
    """Newest records of the years up to and with the first, newest first, that has
    more than ``enough`` valid ones. Pages of earlier years are not opened; those whose
    name gives no year always are. Each page is read once."""
    pages = pages_by_year(spark, path)
    parts = [stored(read_with_page(spark, pages[None]), "records")] if None in pages else []
    for year in sorted((y for y in pages if y is not None), reverse=True):
        parts.append(stored(read_with_page(spark, pages[year]), "records"))
        if has_rows(parts[-1], enough + 1):
            break
    if not parts:
        raise ValueError(f"no page in {path}")
    return newest_records(append_years(parts))


def append_years(parts: list[DataFrame]) -> DataFrame:
    """The batches of several years as one."""
    return reduce(DataFrame.unionByName, parts)
