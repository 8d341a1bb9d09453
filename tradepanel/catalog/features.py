"""Features of the panel."""

from pyspark.sql import functions as F

from ..functions import gdp as G
from ..operators import features as X
from ..operators import panel
from .ctes import BY_COUNTRY, LAST_THREE
from .registry import query

KEY = ("country_code", "year")


def feature(name, sql, source, build, places=None):
    """One feature of every row of a source; rounded on both sides where the
    engines' functions may differ in the last digit."""
    value = sql if places is None else f"round({sql}, {places})"

    @query(name, f"SELECT country_code, year, {value} AS feature FROM {source}")
    def run(t):
        df, column = build(t)
        column = column if places is None else F.round(column, places)
        return df.select(*KEY, column.alias("feature"))


def on_panel(column):
    return lambda t: (t.panel(), column())


def on_exports(column):
    def build(t):
        rows = panel.major_economies(panel.ml_rows(t.panel()))
        return X.join_yearly_exports(rows, t.yearly()), column()

    return build


def on_averages(column):
    return lambda t: (X.join_yearly_averages(t.panel(), t.averages()), column())


c = F.col
feature("f1_ranking_normalized", "ranking / 200.0::DOUBLE", "panel",
        on_panel(lambda: G.ranking_normalized(c("ranking"))))
feature("f2_gdp_per_capita_proxy", "gdp_billion_usd / (ranking + 1)", "panel",
        on_panel(lambda: G.per_rank(c("gdp_billion_usd"), c("ranking"))))
feature("f3_economic_momentum",
        "CASE WHEN gdp_growth_rate > 5 THEN 3 WHEN gdp_growth_rate > 2 THEN 2 "
        "WHEN gdp_growth_rate > 0 THEN 1 ELSE 0 END", "panel",
        on_panel(lambda: G.momentum(c("gdp_growth_rate"))))
feature("f4_export_gdp_ratio",
        "CASE WHEN gdp_value > 0 THEN total_exports_usd / gdp_value ELSE 0 END", "joined_yearly",
        on_exports(lambda: G.share_or_zero(c("total_exports_usd"), c("gdp_value"))))
feature("f5_export_diversity_score", "export_destinations * export_products * 0.001::DOUBLE",
        "joined_yearly",
        on_exports(lambda: G.diversity(c("export_destinations"), c("export_products"))))
feature("f8_year_sin", "sin(2 * pi() * (year - 2018) / 6.0::DOUBLE)", "panel",
        lambda t: (lambda df: (df, G.turn_sin(c("year_normalized"))))(
            X.with_year_fraction(t.stored_panel())), 9)
feature("f8_year_cos", "cos(2 * pi() * (year - 2018) / 6.0::DOUBLE)", "panel",
        lambda t: (lambda df: (df, G.turn_cos(c("year_normalized"))))(
            X.with_year_fraction(t.stored_panel())), 9)
feature("f9_economic_stability", "1 / (abs(gdp_growth_rate) + 1)", "joined_averages",
        on_averages(lambda: G.stability(c("gdp_growth_rate"))))
feature("f10_growth_momentum",
        "gdp_growth_rate * (gdp_value / avg(gdp_value) OVER (PARTITION BY year))",
        "joined_averages",
        lambda t: (X.with_gdp_vs_year_mean(X.join_yearly_averages(t.panel(), t.averages())),
                   c("gdp_growth_rate") * c("gdp_vs_year_mean")), 6)
feature("f11_gdp_local_fob_ratio",
        "CASE WHEN local_avg_fob > 0 THEN gdp_billion_usd / local_avg_fob ELSE 0 END",
        "joined_averages",
        on_averages(lambda: G.share_or_zero(c("gdp_billion_usd"), c("local_avg_fob"))))
feature("f12_gdp_export_diversity", "gdp_billion_usd * local_unique_destinations",
        "joined_averages",
        on_averages(lambda: c("gdp_billion_usd") * c("local_unique_destinations")))
feature("f13_export_intensity", "local_export_records / (gdp_billion_usd + 1)",
        "joined_averages",
        on_averages(lambda: G.export_intensity(c("local_export_records"), c("gdp_billion_usd"))))
feature("f14_growth_ranking_interaction", "gdp_growth_rate / (ranking + 1)", "joined_averages",
        on_averages(lambda: G.per_rank(c("gdp_growth_rate"), c("ranking"))))


@query(
    "f6_year_features",
    """SELECT country_code, year, year - 2019 AS years_since_2019, year * year AS year_squared
       FROM panel""",
)
def f6(t):
    return t.panel().select(
        *KEY, G.years_since_start(c("year")).alias("years_since_2019"),
        (c("year") * c("year")).alias("year_squared"),
    )


@query(
    "f7_economy_flags",
    """SELECT country_code, year,
       CASE WHEN gdp_billion_usd >= 1000 THEN 1 ELSE 0 END AS is_major_economy,
       CASE WHEN gdp_billion_usd >= 100 AND gdp_billion_usd < 1000 THEN 1 ELSE 0 END
         AS is_emerging_market FROM panel""",
)
def f7(t):
    return t.panel().select(
        *KEY, G.is_big_economy(c("gdp_billion_usd")).alias("is_major_economy"),
        G.is_emerging(c("gdp_billion_usd")).alias("is_emerging_market"),
    )


@query(
    "w3_lags",
    f"""SELECT country_code, year, lag(gdp_value) {BY_COUNTRY} AS gdp_lag_1,
        lag(gdp_value, 2) {BY_COUNTRY} AS gdp_lag_2,
        lag(gdp_growth_rate) {BY_COUNTRY} AS gdp_growth_lag_1,
        lag(ranking) {BY_COUNTRY} AS ranking_lag_1 FROM panel""",
)
def w3(t):
    return X.with_lags(t.panel()).select(
        *KEY, "gdp_lag_1", "gdp_lag_2", "gdp_growth_lag_1", "ranking_lag_1"
    )


feature("w4_gdp_moving_average", f"avg(gdp_billion_usd) {LAST_THREE}", "panel",
        on_panel(lambda: X.moving_average("gdp_billion_usd")), 6)
feature("w5_growth_moving_average", f"avg(gdp_growth_rate) {LAST_THREE}", "panel",
        on_panel(lambda: X.moving_average("gdp_growth_rate")), 6)
feature("w6_growth_volatility", f"coalesce(stddev_samp(gdp_growth_rate) {LAST_THREE}, 0)", "panel",
        on_panel(lambda: X.moving_deviation("gdp_growth_rate")), 6)
feature("w7_gdp_volatility", f"coalesce(stddev_samp(gdp_billion_usd) {LAST_THREE}, 0)", "panel",
        on_panel(lambda: X.moving_deviation("gdp_billion_usd")), 6)
feature("w8_ranking_change", f"ranking - lag(ranking) {BY_COUNTRY}", "panel",
        on_panel(lambda: X.change("ranking")))
feature("w9_gdp_change", f"gdp_value - lag(gdp_value) {BY_COUNTRY}", "panel",
        on_panel(lambda: X.change("gdp_value")))
feature("w10_gdp_pct_change", f"gdp_value / lag(gdp_value) {BY_COUNTRY} - 1", "panel",
        on_panel(lambda: X.relative_change("gdp_value")))
feature("w11_gdp_vs_year_mean", "gdp_value / avg(gdp_value) OVER (PARTITION BY year)", "panel",
        lambda t: (X.with_gdp_vs_year_mean(t.panel()), c("gdp_vs_year_mean")), 6)


def rank_share(column):
    return f"""(rank() OVER (PARTITION BY year ORDER BY {column})
        + (count(*) OVER (PARTITION BY year, {column}) - 1) / 2.0::DOUBLE)
        / count(*) OVER (PARTITION BY year)"""


feature("w12_ranking_percentile", rank_share("ranking"), "panel",
        on_panel(lambda: X.average_rank_share("ranking")))
feature("w13_gdp_percentile", rank_share("gdp_value"), "panel",
        on_panel(lambda: X.average_rank_share("gdp_value")))
feature("w14_region_gdp_mean", "avg(gdp_billion_usd) OVER (PARTITION BY region)", "panel",
        on_panel(lambda: F.avg("gdp_billion_usd").over(X.in_region())), 6)
feature("w15_year_normalized",
        "(year - min(year) OVER ()) / CAST(max(year) OVER () - min(year) OVER () AS DOUBLE)",
        "panel",
        lambda t: (X.with_year_fraction(t.stored_panel()), c("year_normalized")))


# Averages and deviations add up doubles, and the last digit of logarithms and
# sines is the library's own: these are compared to 6 places, money in billions.
# All other features are compared exactly.
MONEY = {
    "gdp_ma_3yr", "gdp_rolling_mean_3", "gdp_rolling_std_3", "region_gdp_interaction",
}
INEXACT = MONEY | {
    "gdp_growth_ma_3yr", "gdp_volatility", "log10_gdp", "year_sin", "year_cos",
    "growth_rolling_mean_3", "gdp_vs_year_mean", "growth_momentum", "growth_volatility",
}


def comparable(df, money=MONEY):
    def shown(name):
        if name not in INEXACT:
            return c(name)
        return F.round(c(name) / F.lit(1e9) if name in money else c(name), 6).alias(name)

    return df.select(*[shown(name) for name in df.columns if name != "country_name"])


def comparable_sql(columns, money=MONEY):
    def shown(name):
        if name not in INEXACT:
            return name
        return f"round({name + ' / 1e9' if name in money else name}, 6) AS {name}"

    return ", ".join(shown(name) for name in columns)


SHORT_COLUMNS = ["country_code", X.TARGET, *X.SHORT_FEATURES]

SHORT_SQL = f"""
    SELECT {comparable_sql(SHORT_COLUMNS)} FROM (
      SELECT country_code, gdp_billion_usd, year, year - 2019 AS years_since_2019,
        year * year AS year_squared, ranking, ranking / 200.0::DOUBLE AS ranking_normalized,
        coalesce(ranking - lag(ranking) {BY_COUNTRY}, 0) AS ranking_change,
        gdp_growth_rate, coalesce(lag(gdp_growth_rate) {BY_COUNTRY}, 0) AS gdp_growth_lag_1,
        avg(gdp_growth_rate) {LAST_THREE} AS gdp_growth_ma_3yr,
        lag(gdp_value) {BY_COUNTRY} AS gdp_lag_1,
        coalesce(lag(gdp_value, 2) {BY_COUNTRY}, 0) AS gdp_lag_2,
        avg(gdp_value) {LAST_THREE} AS gdp_ma_3yr,
        gdp_billion_usd / (ranking + 1) AS gdp_per_capita_proxy,
        CASE WHEN gdp_growth_rate > 5 THEN 3 WHEN gdp_growth_rate > 2 THEN 2
          WHEN gdp_growth_rate > 0 THEN 1 ELSE 0 END AS economic_momentum,
        total_exports_usd, export_transactions, export_destinations,
        total_exports_usd / gdp_value AS export_gdp_ratio,
        export_destinations * export_products * 0.001::DOUBLE AS export_diversity_score,
        CASE WHEN gdp_billion_usd >= 1000 THEN 1 ELSE 0 END AS is_major_economy,
        CASE WHEN gdp_billion_usd >= 100 AND gdp_billion_usd < 1000 THEN 1 ELSE 0 END
          AS is_emerging_market,
        coalesce(stddev_samp(gdp_growth_rate) {LAST_THREE}, 0) AS gdp_volatility
      FROM joined_yearly)
    WHERE gdp_lag_1 > 0 AND gdp_growth_rate IS NOT NULL"""


@query("m17_short_features", SHORT_SQL)
def m17(t):
    return comparable(t.short_features())


LONG_COLUMNS = ["country_code", X.TARGET, *X.LONG_FEATURES]
# Its volatility is that of GDP itself, not of growth.
LONG_MONEY = MONEY | {"gdp_volatility"}

LONG_SQL = f"""
    SELECT {comparable_sql(LONG_COLUMNS, LONG_MONEY)} FROM (
      SELECT *, gdp_growth_rate * gdp_vs_year_mean AS growth_momentum,
        gdp_rolling_std_3 AS gdp_volatility,
        sin(2 * pi() * year_normalized) AS year_sin, cos(2 * pi() * year_normalized) AS year_cos
      FROM (SELECT *,
        (year - min(year) OVER ()) / CAST(max(year) OVER () - min(year) OVER () AS DOUBLE)
          AS year_normalized,
        lag(gdp_value) {BY_COUNTRY} AS gdp_lag_1, lag(gdp_value, 2) {BY_COUNTRY} AS gdp_lag_2,
        lag(gdp_growth_rate) {BY_COUNTRY} AS gdp_growth_lag_1,
        lag(ranking) {BY_COUNTRY} AS ranking_lag_1,
        avg(gdp_value) {LAST_THREE} AS gdp_rolling_mean_3,
        coalesce(stddev_samp(gdp_value) {LAST_THREE}, 0) AS gdp_rolling_std_3,
        avg(gdp_growth_rate) {LAST_THREE} AS growth_rolling_mean_3,
        coalesce(stddev_samp(gdp_growth_rate) {LAST_THREE}, 0) AS growth_volatility,
        gdp_value - lag(gdp_value) {BY_COUNTRY} AS gdp_change,
        ranking - lag(ranking) {BY_COUNTRY} AS ranking_change,
        gdp_value / lag(gdp_value) {BY_COUNTRY} - 1 AS gdp_pct_change,
        gdp_value / avg(gdp_value) OVER (PARTITION BY year) AS gdp_vs_year_mean,
        {rank_share("ranking")} AS ranking_percentile,
        {rank_share("gdp_value")} AS gdp_percentile,
        avg(gdp_value) OVER (PARTITION BY region) AS region_gdp_interaction,
        gdp_billion_usd / (ranking + 1) AS gdp_per_capita_proxy,
        1 / (abs(gdp_growth_rate) + 1) AS economic_stability,
        CASE WHEN local_avg_fob > 0 THEN gdp_billion_usd / local_avg_fob ELSE 0 END
          AS gdp_local_fob_ratio,
        gdp_billion_usd * local_unique_destinations AS gdp_export_diversity,
        local_export_records / (gdp_billion_usd + 1) AS export_intensity,
        gdp_growth_rate / (ranking + 1) AS gdp_growth_ranking_interaction,
        dense_rank() OVER (ORDER BY country_code) - 1 AS country_code_encoded,
        dense_rank() OVER (ORDER BY region) - 1 AS region_encoded,
        dense_rank() OVER (ORDER BY economy_size) - 1 AS economy_size_encoded
      FROM joined_averages))
    WHERE gdp_lag_1 IS NOT NULL"""


@query("m16_long_features", LONG_SQL)
def m16(t):
    raw = t.raw("YEAR", "US$ FOB", "PESO BRUTO", "PAIS DE DESTINO", "PRODUCTO", "REGION DE ORIGEN")
    return comparable(X.long_features(t.stored_panel(), raw), LONG_MONEY)
