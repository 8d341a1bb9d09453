"""Questions the dashboard asks. An empty list of years or countries means all."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import cleaning as C
from ..functions import gdp as G
from . import features, marts, rollup
from .exports import filter_in, keep_columns, value_column
from .quantiles import quantiles
from .totals import mean, total

EXPORT_KEY = ("NUMERO DE ACEPTACION", "ITEM")
PANEL_KEY = ("country_code", "year")


def run_statistics(exports: DataFrame, pre: DataFrame | None = None) -> DataFrame:
    """One pass over the lines for all numbers of a run."""
    pre = pre or marts.pre_aggregate(exports.select("YEAR", "PAIS_DESTINO_CLEAN", "FOB_CLEAN"))
    sums = {"total_records": rollup.rows(), "total_fob_usd": rollup.total("fob")}
    distinct = {"years_covered": "YEAR", "destination_countries": "PAIS_DESTINO_CLEAN"}
    return rollup.rolled_up(pre, (), sums, distinct)


def gdp_overview(panel: DataFrame, years=None) -> DataFrame:
    """A8."""
    gdp = F.col("gdp_value")
    return filter_in(panel, "year", years).agg(
        F.count("*").alias("total_records"),
        F.countDistinct("country_code").alias("total_countries"),
        mean(gdp).alias("avg_gdp"),
        F.max(gdp).alias("max_gdp"),
        F.min(gdp).alias("min_gdp"),
    )


def export_overview(exports: DataFrame, years=None) -> DataFrame:
    """A9."""
    fob = value_column(exports)
    return filter_in(exports, "YEAR", years).agg(
        F.count("*").alias("total_records"),
        F.countDistinct("PAIS_DESTINO_CLEAN").alias("total_countries"),
        total(fob).alias("total_fob_usd"),
        mean(fob).alias("avg_fob_usd"),
    )


def export_trend(exports: DataFrame, years=None) -> DataFrame:
    """A10."""
    fob = value_column(exports)
    return (
        filter_in(exports, "YEAR", years)
        .groupBy(F.col("YEAR").alias("year"))
        .agg(mean(fob).alias("avg_value"), F.count(fob).alias("record_count"))
        .withColumn("category", F.lit("exports"))
    )


def _by_region(panel: DataFrame, years=None) -> DataFrame:
    return (
        filter_in(panel, "year", years)
        .groupBy("region")
        .agg(
            total(F.col("gdp_value")).alias("total_gdp"),
            F.avg("gdp_growth_rate").alias("avg_growth"),
            F.count("country_code").alias("country_year_count"),
            F.countDistinct("country_code").alias("country_count"),
        )
    )


def regional_performance(panel: DataFrame, years=None) -> DataFrame:
    """A11, with both the number of rows and of countries; the highest GDP first."""
    return _by_region(panel, years).orderBy(F.desc("total_gdp"))


def regional_share(panel: DataFrame, years=None) -> DataFrame:
    """Each region's share of GDP. The total is over one row per region."""
    regions = _by_region(panel, years)
    share = F.col("total_gdp") / F.sum("total_gdp").over(Window.partitionBy())
    return regions.select("region", "total_gdp", share.alias("share"))


def export_data_summary(exports: DataFrame, years=None, pre: DataFrame | None = None) -> DataFrame:
    """A12."""
    pre = pre or marts.pre_aggregate(filter_in(exports, "YEAR", years).drop("FOB_PER_KG"))
    sums = {"total_records": rollup.rows(), "total_fob_usd": rollup.total("fob")}
    distinct = {
        "unique_countries": "PAIS_DESTINO_CLEAN",
        "unique_products": "PRODUCTO_CLEAN",
        "unique_regions": "REGION_ORIGEN_CLEAN",
    }
    return rollup.rolled_up(filter_in(pre, "YEAR", years), (), sums, distinct)


def export_load_statistics(exports: DataFrame, run_date: date | None = None) -> DataFrame:
    """What was loaded on or after the run date."""
    if run_date is not None:
        exports = exports.filter(F.col("EXTRACTION_DATE") >= F.lit(run_date))
    return exports.agg(
        F.count("*").alias("total_records"),
        F.countDistinct("SOURCE_FILE").alias("total_files"),
        F.min("EXTRACTION_DATE").alias("first_extraction"),
        F.max("EXTRACTION_DATE").alias("last_extraction"),
    )


def gdp_load_statistics(panel: DataFrame) -> DataFrame:
    """A16."""
    gdp = F.col("gdp_value")
    return panel.agg(
        F.count("*").alias("total_records"),
        F.countDistinct("country_code").alias("total_countries"),
        F.countDistinct("year").alias("total_years"),
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
        F.countDistinct("region").alias("total_regions"),
        mean(gdp).alias("avg_gdp"),
        F.max(gdp).alias("max_gdp"),
    )


def available_years(panel: DataFrame) -> DataFrame:
    """Newest first."""
    return panel.select("year").dropna().distinct().orderBy(F.desc("year"))


def available_countries(panel: DataFrame) -> DataFrame:
    """By name."""
    return panel.select("country_name").dropna().distinct().orderBy("country_name")


def completeness(panel: DataFrame, exports: DataFrame) -> DataFrame:
    """Percent of rows with a value, per table; null for an empty table."""
    def share(df, column, dataset):
        return df.agg(
            F.try_divide(F.count(column) * 100, F.count("*")).alias("completeness")
        ).select(F.lit(dataset).alias("dataset"), "completeness")

    return share(panel, F.col("gdp_value"), "gdp").unionByName(
        share(exports, value_column(exports), "exports")
    )


def duplicate_groups(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*[C.named(k) for k in key]).agg(F.count("*").alias("rows")).filter("rows > 1")


def duplicates_and_age(exports: DataFrame, run_date: date, key=EXPORT_KEY) -> DataFrame:
    """Number of repeated keys and age of the newest line in days, in one pass."""
    per_key = exports.groupBy(*[C.named(k) for k in key]).agg(
        F.count("*").alias("_rows"), F.max("EXPORT_DATE").alias("_newest")
    )
    return per_key.agg(
        F.count(F.when(F.col("_rows") > 1, 1)).alias("duplicates"),
        F.datediff(F.lit(run_date), F.max("_newest")).alias("data_age_days"),
    )


def panel_profile(panel: DataFrame) -> DataFrame:
    """A21. The lists are bounded by the number of years and of regions."""
    return panel.agg(
        F.count("*").alias("records"),
        F.countDistinct("country_code").alias("countries"),
        F.concat_ws(",", F.sort_array(F.collect_set("year"))).alias("years"),
        F.concat_ws(",", F.sort_array(F.collect_set("region"))).alias("regions"),
        F.min("gdp_value").alias("min_gdp"),
        F.max("gdp_value").alias("max_gdp"),
    )


FIVE_NUMBERS = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def gdp_distribution(panel: DataFrame, years=None) -> DataFrame:
    """Exact quartiles per year, by counting."""
    names = {f"{name}_gdp": fraction for name, fraction in FIVE_NUMBERS.items()}
    return quantiles(filter_in(panel, "year", years), ["year"], "gdp_value", names).drop("values")


def fob_distribution(exports: DataFrame, *keys: str) -> DataFrame:
    """A22 of the export lines: the same five numbers of the FOB, by any columns; a
    destination with most of the lines is counted by many tasks."""
    names = {f"{name}_fob": fraction for name, fraction in FIVE_NUMBERS.items()}
    return quantiles(exports, list(keys), "FOB_CLEAN", names)


def category_summary(exports: DataFrame, years=None) -> DataFrame:
    """A23."""
    return (
        filter_in(exports, "YEAR", years)
        .groupBy(F.col("EXPORT_SIZE_CATEGORY").alias("category"))
        .agg(F.count("*").alias("total_records"), mean(value_column(exports)).alias("avg_value_1"))
    )


def value_trends(exports: DataFrame, years=None) -> DataFrame:
    """Average FOB and weight by year."""
    return (
        filter_in(exports, "YEAR", years)
        .groupBy(F.col("YEAR").alias("year"))
        .agg(
            mean(value_column(exports)).alias("avg_value_1"),
            mean(F.col("PESO_BRUTO_CLEAN"), 3).alias("avg_value_2"),
        )
    )


def category_performance(exports: DataFrame, years=None) -> DataFrame:
    """A25."""
    return (
        filter_in(exports, "YEAR", years)
        .groupBy(F.col("EXPORT_SIZE_CATEGORY").alias("category"))
        .agg(total(value_column(exports)).alias("total_value"))
    )


def monthly_patterns(exports: DataFrame, years=None) -> DataFrame:
    """Average by category and month, in long form."""
    return (
        filter_in(exports, "YEAR", years)
        .groupBy(F.col("EXPORT_SIZE_CATEGORY").alias("category"), F.col("MES").alias("month"))
        .agg(mean(value_column(exports)).alias("avg_value"))
    )


def monthly_pattern_table(exports: DataFrame, years=None) -> DataFrame:
    """The same with one column per month; the months are known, so the
    pivot needs no extra pass to find them."""
    table = (
        monthly_patterns(exports, years)
        .groupBy("category")
        .pivot("month", list(range(1, 13)))
        .agg(F.first("avg_value"))
    )
    return table.withColumnsRenamed({str(m): f"month_{m}" for m in range(1, 13)})


def economic_indicators(panel: DataFrame, years=None, countries=None) -> DataFrame:
    """A27. Volatility needs the years before the chosen ones, so rows are
    chosen last."""
    wide = features.with_growth_volatility(features.with_gdp_vs_year_mean(panel))
    wide = wide.select(
        "country_code", "country_name", "year",
        F.col("growth_volatility").alias("gdp_volatility"),
        (F.lit(1.0) / (F.col("growth_volatility") + 1)).alias("growth_consistency"),
        G.stability(F.coalesce(F.col("gdp_growth_rate"), F.lit(0.0))).alias("economic_stability"),
        F.col("gdp_vs_year_mean").alias("performance_index"),
    )
    return filter_in(filter_in(wide, "year", years), "country_name", countries)


def gdp_growth_analysis(panel: DataFrame, years=None, countries=None) -> DataFrame:
    """P34."""
    chosen = filter_in(filter_in(panel, "year", years), "country_name", countries)
    return chosen.filter(F.col("gdp_growth_rate").isNotNull()).orderBy("country_name", "year")


def _in_rank_order(panel: DataFrame) -> DataFrame:
    return panel.orderBy(*[name for name in ("year", "ranking") if name in panel.columns])


def gdp_by_year(panel: DataFrame, years=None) -> DataFrame:
    """P35."""
    chosen = filter_in(panel, "year", years)
    return _in_rank_order(keep_columns(chosen, "year", "country_name", "gdp_value", "ranking"))


def gdp_rankings(panel: DataFrame, years=None, countries=None) -> DataFrame:
    """P36."""
    chosen = filter_in(filter_in(panel, "year", years), "country_name", countries)
    return _in_rank_order(chosen)


def top_countries(panel: DataFrame, years=None, k: int = 10) -> DataFrame:
    """O3: the highest GDPs of the newest chosen year. A list of years names
    that year itself; without one it is the newest in the panel."""
    if years:
        newest = panel.filter(F.col("year") == max(years))
    else:
        newest = panel.join(panel.agg(F.max("year").alias("year")), "year", "left_semi")
    return newest.orderBy("ranking", "country_code").limit(k)


def first_countries(df: DataFrame, k: int = 5) -> DataFrame:
    """Rows of the first k country names."""
    names = df.select("country_name").distinct().orderBy("country_name").limit(k)
    return df.join(names, "country_name", "left_semi")


def first_rows(df: DataFrame, *order: str, k: int = 10) -> DataFrame:
    """The first k rows in a total order."""
    return df.orderBy(*order).limit(k)


def rounded(df: DataFrame, *columns: str, places: int = 2) -> DataFrame:
    """Rounded for display."""
    return df.withColumns({name: F.round(C.named(name), places) for name in columns})


def export_context(exports: DataFrame) -> DataFrame:
    """One row per year: average FOB, and total FOB relative to the mean year."""
    yearly = marts.yearly_features(exports)
    mean_total = F.avg("total_exports_usd").over(Window.partitionBy())
    return yearly.select(
        "year",
        F.col("avg_export_value").alias("local_avg_value"),
        (F.col("total_exports_usd") / mean_total).alias("local_performance_score"),
    )


def economic_correlations(panel: DataFrame, exports: DataFrame, years=None, countries=None):
    """The panel beside the exports of the same year."""
    chosen = filter_in(filter_in(panel, "year", years), "country_name", countries)
    return chosen.join(export_context(exports), "year").select(
        "country_name", "region", "year", "gdp_value", "gdp_growth_rate", "local_avg_value",
        "local_performance_score",
    )


def correlation_by_country(correlations: DataFrame) -> DataFrame:
    """Correlation of GDP and average export value per country."""
    return correlations.groupBy("country_name").agg(
        F.corr("gdp_value", "local_avg_value").alias("correlation"),
        F.count("*").alias("years"),
    )


def prediction_validation(predictions: DataFrame) -> DataFrame:
    """Size of the errors; the median is exact and found by counting."""
    middle = quantiles(predictions, [], "absolute_error", {"median": 0.5}).select("median").scalar()
    error, percent = F.col("absolute_error"), F.col("percentage_error")
    return (
        predictions.agg(
            F.count("*").alias("total_predictions"),
            F.avg(error).alias("mean_absolute_error"),
            middle.alias("median_absolute_error"),
            F.avg(percent).alias("mean_percentage_error"),
            F.count(F.when(percent <= 10, 1)).alias("predictions_within_10_percent"),
            F.count(F.when(percent <= 20, 1)).alias("predictions_within_20_percent"),
        )
        .withColumn(
            "is_valid",
            F.coalesce(
                (F.col("mean_percentage_error") < 50)
                & (F.col("predictions_within_20_percent") > F.col("total_predictions") * 0.5),
                F.lit(False),
            ),
        )
    )
