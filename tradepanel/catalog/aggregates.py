"""Marts, reports and joins."""

from datetime import date

from pyspark.sql import functions as F

from ..operators import features, marts, panel, quality, reports
from ..sources.tables import scan_sql, seed_reference_regions
from .ctes import LAST_THREE, mean, total
from .registry import query

FOB = '"FOB_CLEAN"'
YEARS = [2021, 2023]
RUN_DATE = date(2025, 1, 15)


@query("a1_monthly_by_destination", "SELECT * FROM monthly")
def a1(t):
    return t.monthly()


@query("a2_regional_by_year", "SELECT * FROM regional")
def a2(t):
    return t.regional()


@query("a3_product_by_year", "SELECT * FROM product")
def a3(t):
    return t.product()


@query("a4_yearly_features", "SELECT * FROM yearly")
def a4(t):
    return t.yearly()


@query("a5_yearly_averages", "SELECT * FROM averages")
def a5(t):
    return t.averages()


@query(
    "a6_export_summary",
    f"""SELECT "YEAR", "MES", "PAIS DE DESTINO", "REGION DE ORIGEN", count(*) AS export_count,
        {total(FOB)} AS total_fob_usd, {mean(FOB)} AS avg_fob_usd,
        CAST(sum(CAST(try_cast("PESO BRUTO" AS DOUBLE) AS DECIMAL(28,3))) AS DOUBLE)
          AS total_weight_kg,
        count(DISTINCT "RUT PROBABLE EXPORTADOR") AS unique_exporters
        FROM clean GROUP BY 1, 2, 3, 4""",
)
def a6(t):
    return marts.export_summary(
        t.raw("YEAR", "MES", "PAIS DE DESTINO", "REGION DE ORIGEN", "US$ FOB", "PESO BRUTO",
              "RUT PROBABLE EXPORTADOR")
    )


@query(
    "a7_run_statistics",
    f"""SELECT count(*) AS total_records, count(DISTINCT "YEAR") AS years_covered,
        count(DISTINCT "PAIS_DESTINO_CLEAN") AS destination_countries,
        {total(FOB)} AS total_fob_usd FROM clean""",
)
def a7(t):
    return reports.run_statistics(t.clean("YEAR", "PAIS DE DESTINO", "US$ FOB"))


GDP_OVERVIEW = f"""SELECT count(*) AS total_records, count(DISTINCT country_code) AS total_countries,
    {mean('gdp_value')} AS avg_gdp, max(gdp_value) AS max_gdp, min(gdp_value) AS min_gdp FROM panel"""


@query("a8_gdp_overview", GDP_OVERVIEW)
def a8(t):
    return reports.gdp_overview(t.panel())


@query("a8_gdp_overview_chosen", GDP_OVERVIEW + " WHERE year IN (2021, 2023)")
def a8_chosen(t):
    return reports.gdp_overview(t.panel(), YEARS)


EXPORT_OVERVIEW = f"""SELECT count(*) AS total_records,
    count(DISTINCT "PAIS_DESTINO_CLEAN") AS total_countries, {total(FOB)} AS total_fob_usd,
    {mean(FOB)} AS avg_fob_usd FROM clean"""


@query("a9_export_overview", EXPORT_OVERVIEW)
def a9(t):
    return reports.export_overview(t.clean("YEAR", "PAIS DE DESTINO", "US$ FOB"))


@query("a9_export_overview_chosen", EXPORT_OVERVIEW + ' WHERE "YEAR" IN (2021, 2023)')
def a9_chosen(t):
    return reports.export_overview(t.clean("YEAR", "PAIS DE DESTINO", "US$ FOB"), YEARS)


@query(
    "a10_export_trend",
    f"""SELECT "YEAR" AS year, {mean(FOB)} AS avg_value, count({FOB}) AS record_count,
        'exports' AS category FROM clean GROUP BY "YEAR" """,
)
def a10(t):
    return reports.export_trend(t.clean("YEAR", "US$ FOB"))


REGIONAL_GDP = f"""SELECT region, {total('gdp_value')} AS total_gdp,
    round(avg(gdp_growth_rate), 6) AS avg_growth, count(country_code) AS country_year_count,
    count(DISTINCT country_code) AS country_count FROM panel GROUP BY region"""


@query("a11_regional_performance", REGIONAL_GDP)
def a11(t):
    return reports.rounded(reports.regional_performance(t.panel()), "avg_growth", places=6)


@query(
    "a12_export_data_summary",
    f"""SELECT count(*) AS total_records, {total(FOB)} AS total_fob_usd,
        count(DISTINCT "PAIS_DESTINO_CLEAN") AS unique_countries,
        count(DISTINCT "PRODUCTO_CLEAN") AS unique_products,
        count(DISTINCT "REGION_ORIGEN_CLEAN") AS unique_regions FROM clean""",
)
def a12(t):
    return reports.export_data_summary(t.yearly_lines())


BY_COUNTRY = f"""SELECT "PAIS_DESTINO_CLEAN", {total(FOB)} AS "TOTAL_FOB_USD",
    CAST(count(*) AS BIGINT) AS "EXPORT_COUNT" FROM clean GROUP BY "PAIS_DESTINO_CLEAN" """


@query("a13_by_country_from_mart", BY_COUNTRY)
def a13(t):
    return marts.by_country_from_mart(t.monthly())


@query("a14_by_country_from_lines", BY_COUNTRY)
def a14(t):
    return marts.by_country_from_lines(t.clean("PAIS DE DESTINO", "US$ FOB"))


LOADED = """SELECT count(*) AS total_records, count(DISTINCT "SOURCE_FILE") AS total_files,
    strftime(min(extracted), '%Y-%m-%d') AS first_extraction,
    strftime(max(extracted), '%Y-%m-%d') AS last_extraction
    FROM (SELECT "SOURCE_FILE", make_date("YEAR", 12, 31) AS extracted FROM raw) """


def loaded(t, run_date=None):
    """Each source file as if read on the last day of its year."""
    raw = t.raw("SOURCE_FILE", "YEAR")
    at = F.make_timestamp(F.col("YEAR"), F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0))
    found = reports.export_load_statistics(raw.withColumn("EXTRACTION_DATE", at), run_date)
    days = {
        name: F.date_format(name, "yyyy-MM-dd") for name in ("first_extraction", "last_extraction")
    }
    return found.withColumns(days)


@query("a15_export_load_statistics", LOADED)
def a15(t):
    return loaded(t)


@query("a15_export_load_since", LOADED + "WHERE extracted >= DATE '2023-01-01'")
def a15_since(t):
    return loaded(t, date(2023, 1, 1))


@query(
    "a16_gdp_load_statistics",
    f"""SELECT count(*) AS total_records, count(DISTINCT country_code) AS total_countries,
        count(DISTINCT year) AS total_years, min(year) AS min_year, max(year) AS max_year,
        count(DISTINCT region) AS total_regions, {mean('gdp_value')} AS avg_gdp,
        max(gdp_value) AS max_gdp FROM panel""",
)
def a16(t):
    return reports.gdp_load_statistics(t.panel())


@query("a17_available_years", "SELECT DISTINCT year FROM panel")
def a17(t):
    return reports.available_years(t.panel())


@query("a18_available_countries", "SELECT DISTINCT country_name FROM panel")
def a18(t):
    return reports.available_countries(t.panel())


@query(
    "a19_completeness",
    """SELECT 'gdp' AS dataset, count(value) * 100 / CAST(count(*) AS DOUBLE) AS completeness
       FROM records UNION ALL
       SELECT 'exports', count("US$ FOB") * 100 / CAST(count(*) AS DOUBLE) FROM raw""",
)
def a19(t):
    records = t.records().withColumnRenamed("value", "gdp_value")
    return reports.completeness(records, t.raw("US$ FOB"))


@query(
    "a20_duplicates_and_age",
    """SELECT (SELECT count(*) FROM (SELECT 1 FROM clean
         GROUP BY "NUMERO DE ACEPTACION", "ITEM" HAVING count(*) > 1)) AS duplicates,
       (SELECT CAST(date_diff('day', max("EXPORT_DATE"), DATE '2025-01-15') AS INT)
        FROM clean) AS data_age_days""",
)
def a20(t):
    lines = t.clean("NUMERO DE ACEPTACION", "ITEM", "YEAR", "MES", "DIA", "US$ FOB")
    return reports.duplicates_and_age(lines, RUN_DATE)


@query(
    "a20_duplicate_groups",
    """SELECT "NUMERO DE ACEPTACION", "ITEM", count(*) AS rows FROM raw
       GROUP BY "NUMERO DE ACEPTACION", "ITEM" HAVING count(*) > 1""",
)
def a20_groups(t):
    return reports.duplicate_groups(t.raw(*reports.EXPORT_KEY), *reports.EXPORT_KEY)


@query(
    "a21_panel_profile",
    """SELECT count(*) AS records, count(DISTINCT country_code) AS countries,
       string_agg(DISTINCT CAST(year AS VARCHAR), ',' ORDER BY CAST(year AS VARCHAR)) AS years,
       string_agg(DISTINCT region, ',' ORDER BY region) AS regions, min(gdp_value) AS min_gdp,
       max(gdp_value) AS max_gdp FROM panel""",
)
def a21(t):
    return reports.panel_profile(t.panel())


QUARTILES = ("min_gdp", "q1_gdp", "median_gdp", "q3_gdp", "max_gdp")


@query(
    "a22_gdp_distribution",
    """SELECT year, round(min(gdp_value) / 1e9, 6) AS min_gdp,
       round(quantile_cont(gdp_value, 0.25) / 1e9, 6) AS q1_gdp,
       round(quantile_cont(gdp_value, 0.5) / 1e9, 6) AS median_gdp,
       round(quantile_cont(gdp_value, 0.75) / 1e9, 6) AS q3_gdp,
       round(max(gdp_value) / 1e9, 6) AS max_gdp FROM panel GROUP BY year""",
)
def a22(t):
    """In billions: interpolated quartiles have more places than either engine keeps."""
    found = reports.gdp_distribution(t.panel())
    return found.withColumns({name: F.round(F.col(name) / 1e9, 6) for name in QUARTILES})


def five_numbers(source):
    parts = ("min(f)", *[f"quantile_cont(f, {x})" for x in (0.25, 0.5, 0.75)], "max(f)")
    names = ("min_fob", "q1_fob", "median_fob", "q3_fob", "max_fob")
    return ", ".join(f"round({part}, 4) AS {name}" for part, name in zip(parts, names)) + f" FROM ({source})"


@query(
    "a22_fob_by_destination",
    f"""SELECT destination, CAST(count(*) AS BIGINT) AS values, {five_numbers('SELECT "PAIS_DESTINO_CLEAN" AS destination, "FOB_CLEAN" AS f FROM clean')}
        GROUP BY destination""",
)
def a22_by_destination(t):
    found = reports.fob_distribution(t.clean("US$ FOB", "PAIS DE DESTINO"), "PAIS_DESTINO_CLEAN")
    numbers = [n for n in found.columns if n.endswith("_fob")]
    return found.withColumns({n: F.round(n, 4) for n in numbers}).withColumnRenamed("PAIS_DESTINO_CLEAN", "destination")


@query(
    "a22_fob_of_all_lines",
    f"""SELECT CAST(count(*) AS BIGINT) AS values, {five_numbers('SELECT "FOB_CLEAN" AS f FROM clean')}""",
)
def a22_all(t):
    """One group that holds all lines."""
    found = reports.fob_distribution(t.clean("US$ FOB"))
    return found.withColumns({n: F.round(n, 4) for n in found.columns if n.endswith("_fob")})


@query(
    "a23_category_summary",
    f"""SELECT "EXPORT_SIZE_CATEGORY" AS category, count(*) AS total_records,
        {mean(FOB)} AS avg_value_1 FROM clean GROUP BY 1""",
)
def a23(t):
    return reports.category_summary(t.clean("YEAR", "US$ FOB"))


@query(
    "a24_value_trends",
    f"""SELECT "YEAR" AS year, {mean(FOB)} AS avg_value_1,
        {mean('"PESO_BRUTO_CLEAN"', 3)} AS avg_value_2 FROM clean GROUP BY 1""",
)
def a24(t):
    return reports.value_trends(t.clean("YEAR", "US$ FOB", "PESO BRUTO"))


@query(
    "a25_category_performance",
    f'SELECT "EXPORT_SIZE_CATEGORY" AS category, {total(FOB)} AS total_value FROM clean GROUP BY 1',
)
def a25(t):
    return reports.category_performance(t.clean("YEAR", "US$ FOB"))


@query(
    "a26_monthly_patterns",
    f"""SELECT "EXPORT_SIZE_CATEGORY" AS category, "MES" AS month, {mean(FOB)} AS avg_value
        FROM clean GROUP BY 1, 2""",
)
def a26(t):
    return reports.monthly_patterns(t.clean("YEAR", "MES", "US$ FOB"))


_months = ", ".join(
    f'{mean(f"""CASE WHEN "MES" = {m} THEN {FOB} END""")} AS month_{m}' for m in range(1, 13)
)


@query(
    "a26_monthly_pattern_table",
    f'SELECT "EXPORT_SIZE_CATEGORY" AS category, {_months} FROM clean GROUP BY 1',
)
def a26_table(t):
    return reports.monthly_pattern_table(t.clean("YEAR", "MES", "US$ FOB"))


@query(
    "a27_economic_indicators",
    f"""SELECT country_code, country_name, year, round(v, 6) AS gdp_volatility,
        round(1 / (v + 1), 6) AS growth_consistency,
        round(1 / (abs(coalesce(g, 0)) + 1), 9) AS economic_stability,
        round(p, 6) AS performance_index
        FROM (SELECT country_code, country_name, year, gdp_growth_rate AS g,
                coalesce(stddev_samp(gdp_growth_rate) {LAST_THREE}, 0) AS v,
                gdp_value / avg(gdp_value) OVER (PARTITION BY year) AS p FROM panel)""",
)
def a27(t):
    df = reports.economic_indicators(t.panel())
    df = reports.rounded(
        df, "gdp_volatility", "growth_consistency", "performance_index", places=6
    )
    return reports.rounded(df, "economic_stability", places=9)


@query("a28_export_analytics", "SELECT * FROM export_analytics")
def a28(t):
    return t.export_analytics()


LAST_YEAR_AS_FORECAST = """SELECT country_code, year, gdp_billion_usd AS actual_gdp,
    lag(gdp_billion_usd) OVER (PARTITION BY country_code ORDER BY year) AS predicted_gdp FROM panel"""


@query(
    "a29_prediction_validation",
    f"""SELECT count(*) AS total_predictions, round(avg(e), 6) AS mean_absolute_error,
        round(median(e), 6) AS median_absolute_error, round(avg(p), 6) AS mean_percentage_error,
        count(*) FILTER (p <= 10) AS predictions_within_10_percent,
        count(*) FILTER (p <= 20) AS predictions_within_20_percent,
        avg(p) < 50 AND count(*) FILTER (p <= 20) > count(*) * 0.5 AS is_valid
        FROM (SELECT abs(actual_gdp - predicted_gdp) AS e,
                abs(actual_gdp - predicted_gdp) / actual_gdp * 100 AS p
              FROM ({LAST_YEAR_AS_FORECAST}) WHERE predicted_gdp IS NOT NULL)""",
)
def a29(t):
    from ..operators.learning import with_errors

    forecast = t.panel().select(
        "country_code", "year", F.col("gdp_billion_usd").alias("actual_gdp"),
        features.before("gdp_billion_usd").alias("predicted_gdp"),
    )
    found = reports.prediction_validation(
        with_errors(forecast.filter(F.col("predicted_gdp").isNotNull()))
    )
    return reports.rounded(
        found, "mean_absolute_error", "median_absolute_error", "mean_percentage_error", places=6
    )


JOINED = """country_code, year, gdp_value, total_exports_usd, avg_export_value,
    export_transactions, export_destinations, export_products, export_regions"""


@query("j1_panel_with_yearly_exports", f"SELECT {JOINED} FROM joined_yearly")
def j1(t):
    joined = features.join_yearly_exports(
        panel.major_economies(panel.ml_rows(t.panel())), t.yearly()
    )
    return joined.select(*[name.strip() for name in JOINED.split(",")])


@query(
    "j2_panel_with_yearly_averages",
    """SELECT country_code, year, gdp_growth_rate, local_avg_fob, local_avg_weight,
       local_export_records, local_unique_destinations, local_unique_products,
       local_unique_regions, round(log10_gdp, 9) AS log10_gdp FROM joined_averages""",
)
def j2(t):
    return features.join_yearly_averages(t.panel(), t.averages()).select(
        "country_code", "year", "gdp_growth_rate", "local_avg_fob", "local_avg_weight",
        "local_export_records", "local_unique_destinations", "local_unique_products",
        "local_unique_regions", F.round("log10_gdp", 9).alias("log10_gdp"),
    )


@query(
    "j2_panel_with_averages_in_sql",
    """SELECT country_code, year, local_avg_fob, local_export_records FROM joined_averages""",
)
def j2_sql(t):
    return scan_sql(
        t.spark,
        """WITH exports AS (SELECT * FROM {averages}), gdp AS (
             SELECT * FROM {panel} WHERE gdp_value > 0)
           SELECT country_code, gdp.year, coalesce(avg_fob_value, 0) AS local_avg_fob,
                  coalesce(export_records, 0) AS local_export_records
           FROM gdp LEFT JOIN exports ON gdp.year = exports.year
           ORDER BY gdp.year, ranking""",
        averages=t.averages(), panel=t.panel(),
    )


@query(
    "j3_latest_year",
    """SELECT country_code, year, gdp_value FROM panel
       WHERE year = (SELECT max(year) FROM panel)""",
)
def j3(t):
    return panel.latest_year(t.stored_panel()).select("country_code", "year", "gdp_value")


@query(
    "j4_anti_join_codes",
    """SELECT country_code, year FROM gdp
       WHERE country_code NOT IN ('WLD', 'EUU', 'HIC')""",
)
def j4(t):
    records = t.gdp()
    return panel.without_codes(records, panel.excluded_codes(records)).select("country_code", "year")


@query(
    "j5_insert_if_absent",
    """SELECT analysis_type, year, region, total_fob_usd, export_count FROM export_analytics
       UNION ALL
       SELECT 'regional_reference', 2024, unnest(['REGION METROPOLITANA', 'REGION DE VALPARAISO',
         'REGION DEL BIOBIO', 'REGION DE LA ARAUCANIA', 'REGION DE ANTOFAGASTA',
         'REGION DE ATACAMA', 'REGION DE COQUIMBO', 'REGION DEL MAULE', 'REGION DE LOS LAGOS',
         'REGION DE MAGALLANES']), 0, 0""",
)
def j5(t):
    facts = t.export_analytics()
    once = seed_reference_regions(facts)
    return once.select("analysis_type", "year", "region", "total_fob_usd", "export_count")


MODELS = "SELECT DISTINCT 'v' || year AS model_version FROM panel WHERE year <= 2022"


def predictions_and_registry(t):
    """Predictions under one version per year; versions up to 2022 are registered."""
    rows = t.stored_panel()
    version = F.concat(F.lit("v"), F.col("year").cast("string")).alias("model_version")
    registry = rows.filter("year <= 2022").select(version).distinct()
    return rows.select(version, "country_code", "year"), registry


@query(
    "j6_orphan_predictions",
    f"""SELECT 'v' || year AS model_version, country_code, year FROM panel
        WHERE 'v' || year NOT IN ({MODELS})""",
)
def j6(t):
    return quality.orphan_predictions(*predictions_and_registry(t))


@query(
    "j7_economic_correlations",
    """SELECT country_name, region, year, gdp_value, gdp_growth_rate,
       avg_export_value AS local_avg_value,
       round(total_exports_usd / mean_total, 9) AS local_performance_score
       FROM panel JOIN (SELECT *, avg(total_exports_usd) OVER () AS mean_total FROM yearly)
       USING (year)""",
)
def j7(t):
    found = reports.economic_correlations(t.panel(), t.yearly_lines())
    return reports.rounded(found, "local_performance_score", places=9)


@query(
    "j7_correlation_by_country",
    """SELECT country_name, round(corr(gdp_value / 1e9, avg_export_value), 6) AS correlation,
       count(*) AS years FROM panel JOIN yearly USING (year) GROUP BY country_name""",
)
def j7_corr(t):
    found = reports.correlation_by_country(
        reports.economic_correlations(t.panel(), t.yearly_lines())
    )
    return reports.rounded(found, "correlation", places=6)


@query(
    "w16_regional_share",
    f"""SELECT region, {total('gdp_value')} AS total_gdp,
        round({total('gdp_value')} / sum({total('gdp_value')}) OVER (), 9) AS share
        FROM panel GROUP BY region""",
)
def w16(t):
    return reports.rounded(reports.regional_share(t.panel()), "share", places=9)
