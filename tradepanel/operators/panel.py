"""The country-by-year GDP panel.

Its grain is one row per country code and year: a year holds at most as many rows
as there are three-letter codes, and a country as many as there are years. That
bounds every window here, whatever the size of the export table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ..constants import (
    ENOUGH_RECORDS_PER_YEAR,
    EXCLUDED_CODES,
    FIRST_ML_YEAR,
    LAST_ML_YEAR,
    MAJOR_ECONOMY_BN,
)
from ..functions import gdp as G


def by_country() -> WindowSpec:
    return Window.partitionBy("country_code").orderBy("year")


def valid_records(records: DataFrame) -> DataFrame:
    """Records with a value, a country name and a code."""
    def filled(path):
        return F.col(path).isNotNull() & (F.col(path) != "")

    return records.filter(filled("value") & filled("country.value") & filled("countryiso3code"))


def project_records(records: DataFrame, *others: str) -> DataFrame:
    """Flat, typed columns, and others that are to stay."""
    return records.select(
        F.col("countryiso3code").alias("country_code"),
        F.col("country.value").alias("country_name"),
        F.col("indicator.id").alias("indicator_code"),
        F.col("indicator.value").alias("indicator_name"),
        F.col("date").try_cast("int").alias("year"),
        F.col("value").try_cast("double").alias("gdp_value"),
        *others,
    )


def years_until_enough(panel: DataFrame, enough: int = ENOUGH_RECORDS_PER_YEAR) -> DataFrame:
    """Years newest first, up to and with the first that has more than
    ``enough`` records. The window runs over one row per year."""
    counts = panel.groupBy("year").agg(F.count("*").alias("_records"))
    newer = Window.orderBy(F.desc("year")).rowsBetween(Window.unboundedPreceding, -1)
    stopped = F.coalesce(F.max(F.col("_records") > enough).over(newer), F.lit(False))
    wanted = counts.select("year", stopped.alias("_stopped")).filter(~F.col("_stopped"))
    return panel.join(wanted.select("year"), "year", "left_semi").select(*panel.columns)


def known_gdp(panel: DataFrame) -> DataFrame:
    """Rows with a code and a GDP above zero."""
    return panel.dropna(subset=["gdp_value", "country_code"]).filter(F.col("gdp_value") > 0)


def countries_only(panel: DataFrame) -> DataFrame:
    """Without the codes of country groups."""
    return panel.filter(G.is_country(F.col("country_code")))


def without_codes(panel: DataFrame, codes: DataFrame) -> DataFrame:
    """The same against a table of codes; Spark chooses the join by its size."""
    return panel.join(codes, "country_code", "left_anti")


def excluded_codes(panel: DataFrame) -> DataFrame:
    """The fixed list of excluded codes as a table."""
    spark = panel.sparkSession
    return spark.createDataFrame([(code,) for code in EXCLUDED_CODES], "country_code STRING")


def with_classes(panel: DataFrame) -> DataFrame:
    """P24-P27."""
    gdp = F.col("gdp_value")
    return panel.withColumns(
        {
            "gdp_billion_usd": G.billions(gdp),
            "log_gdp": G.log_e(gdp),
            "log10_gdp": G.log_10(gdp),
            "region": G.world_region(F.col("country_code")),
            "economy_size": G.economy_size(gdp),
        }
    )


def with_ranking(panel: DataFrame) -> DataFrame:
    """Dense rank by GDP within the year, highest first."""
    by_gdp = Window.partitionBy("year").orderBy(F.desc("gdp_value"))
    return panel.withColumn("ranking", F.dense_rank().over(by_gdp))


def with_growth(panel: DataFrame) -> DataFrame:
    """Growth over the previous stored year of the country, in percent."""
    before = F.lag("gdp_value").over(by_country())
    return panel.withColumn("gdp_growth_rate", (F.col("gdp_value") / before - 1) * 100)


def build_panel(records: DataFrame) -> DataFrame:
    """The whole panel from flat GDP records.

    Growth needs the earlier years, so this runs over all stored years.
    """
    return with_growth(with_ranking(with_classes(countries_only(known_gdp(records)))))


def with_audit(panel: DataFrame, processed_at: datetime) -> DataFrame:
    """P28."""
    at = F.lit(processed_at)
    return panel.withColumns({"created_at": at, "updated_at": at, "processed_at": at})


def ml_rows(panel: DataFrame, first_year: int = FIRST_ML_YEAR, last_year: int = LAST_ML_YEAR) -> DataFrame:
    """The rows of the years to learn from."""
    return panel.filter(
        (F.col("gdp_value") > 0) & F.col("year").between(first_year, last_year)
    ).select(
        "country_code", "country_name", "year", "gdp_value", "ranking", "gdp_growth_rate",
        "gdp_billion_usd", "log_gdp",
    )


def major_economies(panel: DataFrame) -> DataFrame:
    """P30."""
    return panel.filter(F.col("gdp_billion_usd") >= MAJOR_ECONOMY_BN)


def latest_year(panel: DataFrame) -> DataFrame:
    """The rows of the newest year; the maximum is one row on the other side."""
    newest = panel.agg(F.max("year").alias("year"))
    return panel.join(newest, "year", "left_semi").select(*panel.columns)


def gdp_ranking_latest(panel: DataFrame) -> DataFrame:
    """The ranking view of the newest year."""
    return (
        latest_year(panel)
        .select(
            "country_code", "country_name", "gdp_value", "gdp_billion_usd", "ranking", "region",
            "economy_size", "gdp_growth_rate",
        )
        .orderBy("ranking", "country_code")
    )
