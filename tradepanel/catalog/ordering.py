"""Order, first rows, unions."""

from pyspark.sql import functions as F

from ..operators import marts, panel, reports
from ..sources.export_files import combine
from ..sources.gdp_files import append_years
from .registry import query


@query("o1_mart_order_monthly", 'SELECT * FROM monthly ORDER BY 1, 2, "TOTAL_FOB_USD" DESC')
def o1(t):
    return marts.presented(t.monthly())


@query("o1_mart_order_regional", 'SELECT * FROM regional ORDER BY "YEAR", "TOTAL_FOB_USD" DESC')
def o1_regional(t):
    return marts.presented(t.regional())


@query("o1_mart_order_product", 'SELECT * FROM product ORDER BY "YEAR", "TOTAL_FOB_USD" DESC')
def o1_product(t):
    return marts.presented(t.product())


@query("o2_by_year_and_ranking", "SELECT country_code, year, ranking FROM panel ORDER BY 2, 3")
def o2(t):
    return t.panel().select("country_code", "year", "ranking").orderBy("year", "ranking")


TOP = """SELECT country_name, year, gdp_value, ranking FROM panel
    WHERE year = {year} ORDER BY ranking, country_code LIMIT 10"""


@query("o3_top_countries", TOP.format(year="(SELECT max(year) FROM panel)"))
def o3(t):
    return reports.top_countries(t.stored_panel()).select(
        "country_name", "year", "gdp_value", "ranking"
    )


@query("o3_top_countries_chosen", TOP.format(year=2022))
def o3_chosen(t):
    return reports.top_countries(t.panel(), [2020, 2022]).select(
        "country_name", "year", "gdp_value", "ranking"
    )


@query(
    "o5_gdp_ranking_latest",
    """SELECT country_code, country_name, gdp_value, gdp_billion_usd, ranking, region,
       economy_size, gdp_growth_rate FROM panel
       WHERE year = (SELECT max(year) FROM panel) ORDER BY ranking""",
)
def o5(t):
    return panel.gdp_ranking_latest(t.stored_panel())


@query(
    "o6_first_countries",
    """SELECT country_name, year, gdp_value FROM panel WHERE country_name IN
       (SELECT DISTINCT country_name FROM panel ORDER BY country_name LIMIT 5)""",
)
def o6(t):
    return reports.first_countries(t.stored_panel()).select("country_name", "year", "gdp_value")


@query(
    "o6_first_rows",
    """SELECT country_name, year, gdp_value FROM panel ORDER BY country_name, year LIMIT 10""",
)
def o6_rows(t):
    return reports.first_rows(t.panel(), "country_name", "year").select(
        "country_name", "year", "gdp_value"
    )


@query(
    "u1_union_by_name",
    """SELECT "YEAR", "PRODUCTO", "US$ FOB", NULL::VARCHAR AS "CANTIDAD" FROM raw
       UNION ALL SELECT "YEAR", NULL, "US$ FOB", "CANTIDAD" FROM raw""",
)
def u1(t):
    return combine([t.raw("YEAR", "PRODUCTO", "US$ FOB"), t.raw("CANTIDAD", "US$ FOB", "YEAR")])


@query("u2_union_of_years", "SELECT country_code, year, gdp_value FROM gdp")
def u2(t):
    """The years as separate batches, put together again."""
    rows = t.gdp().select("country_code", "year", "gdp_value")
    return append_years(
        [rows.filter(F.col("year") < 2021), rows.filter(F.col("year") >= 2021)]
    )


@query("u3_distinct_destinations", 'SELECT DISTINCT "PAIS_DESTINO_CLEAN" AS destination FROM clean')
def u3(t):
    lines = t.clean("PAIS DE DESTINO", "US$ FOB")
    return lines.select(F.col("PAIS_DESTINO_CLEAN").alias("destination")).distinct()
