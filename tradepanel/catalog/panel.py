"""The GDP panel."""

from pyspark.sql import functions as F

from ..functions import gdp as G
from ..operators import features, panel, reports
from .adapter import RUN_AT
from .registry import query


@query("p22_known_gdp", "SELECT country_code, year, gdp_value FROM gdp WHERE gdp_value > 0")
def p22(t):
    return panel.known_gdp(t.gdp()).select("country_code", "year", "gdp_value")


@query(
    "p23_countries_only",
    """SELECT country_code, year FROM gdp
       WHERE country_code NOT IN ('WLD', 'EUU', 'HIC')""",
)
def p23(t):
    return panel.countries_only(t.gdp()).select("country_code", "year")


@query("p24_gdp_billions", "SELECT country_code, year, gdp_value / 1e9 AS gdp_bn FROM gdp")
def p24(t):
    return t.gdp().select("country_code", "year", G.billions(F.col("gdp_value")).alias("gdp_bn"))


@query(
    "p25_log_gdp",
    """SELECT country_code, year, round(ln(gdp_value), 9) AS log_gdp,
       round(log10(gdp_value), 9) AS log10_gdp FROM gdp""",
)
def p25(t):
    gdp = F.col("gdp_value")
    return t.gdp().select(
        "country_code", "year", F.round(G.log_e(gdp), 9).alias("log_gdp"),
        F.round(G.log_10(gdp), 9).alias("log10_gdp"),
    )


@query("p26_world_region", "SELECT country_code, year, region FROM classified")
def p26(t):
    return panel.with_classes(panel.countries_only(t.gdp())).select("country_code", "year", "region")


@query("p27_economy_size", "SELECT country_code, year, economy_size FROM classified")
def p27(t):
    return panel.with_classes(panel.countries_only(t.gdp())).select(
        "country_code", "year", "economy_size"
    )


@query(
    "p28_audit_timestamps",
    """SELECT country_code, year, '2025-01-15 06:00:00' AS created_at,
       '2025-01-15 06:00:00' AS updated_at, '2025-01-15 06:00:00' AS processed_at FROM gdp""",
)
def p28(t):
    stamps = [
        F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
        for name in ("created_at", "updated_at", "processed_at")
    ]
    return panel.with_audit(t.gdp(), RUN_AT).select("country_code", "year", *stamps)


@query(
    "p29_ml_rows",
    """SELECT country_code, country_name, year, gdp_value, ranking, gdp_growth_rate,
       gdp_billion_usd, round(log_gdp, 9) AS log_gdp FROM ml_rows""",
)
def p29(t):
    return panel.ml_rows(t.panel()).withColumn("log_gdp", F.round("log_gdp", 9))


@query(
    "p30_major_economies",
    "SELECT country_code, year, gdp_billion_usd FROM panel WHERE gdp_billion_usd >= 10",
)
def p30(t):
    return panel.major_economies(t.panel()).select("country_code", "year", "gdp_billion_usd")


@query(
    "p31_null_fill",
    """SELECT country_code, year, coalesce(lag(gdp_value) OVER (PARTITION BY country_code
       ORDER BY year), 0) AS gdp_lag_1 FROM panel""",
)
def p31(t):
    lagged = t.panel().select("country_code", "year", features.before("gdp_value").alias("gdp_lag_1"))
    return lagged.fillna({"gdp_lag_1": 0.0})


@query(
    "p32_coalesced_growth",
    "SELECT country_code, year, coalesce(gdp_growth_rate, 0) AS gdp_growth_rate FROM panel",
)
def p32(t):
    growth = F.coalesce("gdp_growth_rate", F.lit(0.0)).alias("gdp_growth_rate")
    return t.panel().select("country_code", "year", growth)


@query(
    "p33_rows_with_lag",
    """SELECT * FROM (SELECT country_code, year, lag(gdp_value) OVER (PARTITION BY country_code
       ORDER BY year) AS gdp_lag_1 FROM panel) WHERE gdp_lag_1 > 0""",
)
def p33(t):
    lagged = features.with_lags(t.panel()).select("country_code", "year", "gdp_lag_1")
    return features.drop_without_lag(lagged).dropna()


SHOWN = "country_name, year, gdp_value, ranking, gdp_growth_rate, region, economy_size"


def shown(df):
    return df.select(*SHOWN.split(", "))


@query("p34_growth_analysis", f"SELECT {SHOWN} FROM panel WHERE gdp_growth_rate IS NOT NULL")
def p34(t):
    return shown(reports.gdp_growth_analysis(t.panel()))


@query(
    "p34_growth_analysis_chosen",
    f"""SELECT {SHOWN} FROM panel WHERE gdp_growth_rate IS NOT NULL
        AND year IN (2020, 2021) AND country_name IN ('NATION_0', 'NATION_3')""",
)
def p34_chosen(t):
    return shown(
        reports.gdp_growth_analysis(t.panel(), [2020, 2021], ["NATION_0", "NATION_3"])
    )


@query("p35_gdp_by_year", "SELECT year, country_name, gdp_value, ranking FROM panel")
def p35(t):
    return reports.gdp_by_year(t.panel())


@query("p36_gdp_rankings", f"SELECT {SHOWN} FROM panel")
def p36(t):
    return shown(reports.gdp_rankings(t.panel()))


@query(
    "p36_gdp_rankings_chosen",
    f"""SELECT {SHOWN} FROM panel WHERE year IN (2022, 2023)
        AND country_name IN ('NATION_1', 'NATION_2', 'NATION_7')""",
)
def p36_chosen(t):
    return shown(
        reports.gdp_rankings(t.panel(), [2022, 2023], ["NATION_1", "NATION_2", "NATION_7"])
    )


@query(
    "p37_display_rounding",
    "SELECT country_name, year, round(gdp_billion_usd, 2) AS gdp_billion_usd FROM panel",
)
def p37(t):
    df = t.panel().select("country_name", "year", "gdp_billion_usd")
    return reports.rounded(df, "gdp_billion_usd")


@query("w1_dense_rank", "SELECT country_code, year, ranking FROM panel")
def w1(t):
    ranked = panel.with_ranking(panel.countries_only(panel.known_gdp(t.gdp())))
    return ranked.select("country_code", "year", "ranking")


@query("w2_growth", "SELECT country_code, year, gdp_growth_rate FROM panel")
def w2(t):
    grown = panel.with_growth(panel.countries_only(panel.known_gdp(t.gdp())))
    return grown.select("country_code", "year", "gdp_growth_rate")


@query(
    "w_gdp_panel",
    """SELECT country_code, country_name, indicator_code, indicator_name, year, gdp_value, ranking,
       gdp_growth_rate, gdp_billion_usd, round(log_gdp, 9) AS log_gdp, region, economy_size
       FROM panel""",
)
def w_panel(t):
    return t.panel().select(
        "country_code", "country_name", "indicator_code", "indicator_name", "year", "gdp_value",
        "ranking", "gdp_growth_rate", "gdp_billion_usd", F.round("log_gdp", 9).alias("log_gdp"),
        "region", "economy_size",
    )
