"""Features of the country-by-year panel, and the two training tables.

Windows share three partitionings (country, year, region), so that a table with
many features still needs one exchange for each. The panel's grain bounds them;
see ``panel``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ..constants import LONG_FEATURES, SHORT_FEATURES, TARGET
from ..functions import gdp as G
from . import marts
from .panel import by_country, major_economies, ml_rows


def last_three() -> WindowSpec:
    return by_country().rowsBetween(-2, 0)


def in_year() -> WindowSpec:
    return Window.partitionBy("year")


def in_region() -> WindowSpec:
    return Window.partitionBy("region")


EXPORT_DEFAULTS = {
    "total_exports_usd": 0.0,
    "avg_export_value": 0.0,
    "export_transactions": 0,
    "export_destinations": 0,
    "export_products": 0,
    "export_regions": 0,
}


def before(name: str, rows: int = 1) -> Column:
    """The value some rows back in the country's series."""
    return F.lag(name, rows).over(by_country())


def moving_average(name: str) -> Column:
    """W4, W5."""
    return F.avg(name).over(last_three())


def moving_deviation(name: str) -> Column:
    """Sample deviation of three rows; 0 where it is undefined."""
    return F.coalesce(F.stddev_samp(name).over(last_three()), F.lit(0.0))


def change(name: str) -> Column:
    """W8, W9."""
    return F.col(name) - before(name)


def relative_change(name: str) -> Column:
    """A ratio, not percent."""
    return F.col(name) / before(name) - 1


def in_year_by(name: str) -> WindowSpec:
    return in_year().orderBy(name)


def all_in_year(name: str) -> WindowSpec:
    """The whole year, in the order that ranks of ``name`` need: one sort serves both."""
    return in_year_by(name).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def average_rank_share(name: str) -> Column:
    """Ascending rank within the year over the number of values, where
    equal values share the mean of their ranks: halfway between the first of them and
    the last. All three numbers come from one window. A null has no rank."""
    first = F.rank().over(in_year_by(name))
    last = F.count(F.lit(1)).over(in_year_by(name).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    known = F.count(name).over(all_in_year(name))
    nulls = F.count(F.lit(1)).over(all_in_year(name)) - known  # they come first in the order
    return F.when(F.col(name).isNotNull(), ((first + last) / 2 - nulls) / known)


def with_lags(panel: DataFrame) -> DataFrame:
    """W3."""
    return panel.withColumns(
        {
            "gdp_lag_1": before("gdp_value"),
            "gdp_lag_2": before("gdp_value", 2),
            "gdp_growth_lag_1": before("gdp_growth_rate"),
            "ranking_lag_1": before("ranking"),
        }
    )


def with_growth_volatility(panel: DataFrame) -> DataFrame:
    """W6."""
    return panel.withColumn("growth_volatility", moving_deviation("gdp_growth_rate"))


def with_gdp_vs_year_mean(panel: DataFrame) -> DataFrame:
    """W11."""
    return panel.withColumn(
        "gdp_vs_year_mean", F.col("gdp_value") / F.avg("gdp_value").over(in_year())
    )


def with_year_fraction(df: DataFrame, panel: DataFrame | None = None) -> DataFrame:
    """Position of the year between the first and the last of the panel; null
    if they are the same. First and last are scalar subqueries, not a window over
    the whole table. They are taken from ``panel`` where ``df`` is more than that."""
    panel = df if panel is None else panel
    first = panel.agg(F.min("year")).scalar()
    span = panel.agg(F.max("year") - F.min("year")).scalar()
    return df.withColumn("year_normalized", F.try_divide(F.col("year") - first, span))


def with_category_codes(df: DataFrame, *columns: str, panel: DataFrame | None = None) -> DataFrame:
    """M3 as numbers: each label's place among the labels in alphabetical order; a null
    has none.

    The labels of all columns, which are few, are arrays in one row: a scalar subquery.
    """
    panel = df if panel is None else panel
    labels = panel.agg(F.struct(*[F.sort_array(F.collect_set(name)).alias(name) for name in columns])).scalar()
    place = {name: F.array_position(labels.getField(name), F.col(name)) - 1 for name in columns}
    return df.withColumns({f"{name}_encoded": place[name].cast("int") for name in columns})


def drop_without_lag(df: DataFrame) -> DataFrame:
    """Rows that have a GDP of the year before."""
    return df.filter(F.col("gdp_lag_1") > 0)


def join_yearly_exports(panel: DataFrame, yearly: DataFrame) -> DataFrame:
    """Exports of the same year beside each country, 0 where there are none.
    The right side is one row per year; Spark broadcasts it by its measured size."""
    return panel.join(yearly, "year", "left").fillna(EXPORT_DEFAULTS)


def join_yearly_averages(panel: DataFrame, averages: DataFrame) -> DataFrame:
    """The same with the averages, and growth 0 where it is unknown."""
    renamed = {
        "avg_fob_value": "local_avg_fob",
        "avg_weight": "local_avg_weight",
        "export_records": "local_export_records",
        "unique_destinations": "local_unique_destinations",
        "unique_products": "local_unique_products",
        "unique_regions": "local_unique_regions",
    }
    joined = panel.filter(F.col("gdp_value") > 0).join(averages, "year", "left")
    return joined.select(
        "country_code", "country_name", "year", "gdp_value", "ranking",
        F.coalesce("gdp_growth_rate", F.lit(0.0)).alias("gdp_growth_rate"),
        "region", "economy_size",
        *[F.coalesce(old, F.lit(0)).alias(new) for old, new in renamed.items()],
        G.log_10(F.col("gdp_value")).alias("log10_gdp"),
        G.billions(F.col("gdp_value")).alias(TARGET),
    )


def short_features(panel: DataFrame, exports: DataFrame, pre: DataFrame | None = None, **years: int) -> DataFrame:
    """22 features of the larger economies, the target and the keys; ``first_year``
    and ``last_year`` as in ``ml_rows``, ``pre`` as in ``marts.yearly_features``."""
    base = join_yearly_exports(major_economies(ml_rows(panel, **years)), marts.yearly_features(exports, pre))
    growth, ranking, gdp_bn = F.col("gdp_growth_rate"), F.col("ranking"), F.col(TARGET)
    wide = base.withColumns(
        {
            "gdp_lag_1": before("gdp_value"),
            "gdp_lag_2": before("gdp_value", 2),
            "gdp_growth_lag_1": before("gdp_growth_rate"),
            "gdp_ma_3yr": moving_average("gdp_value"),
            "gdp_growth_ma_3yr": moving_average("gdp_growth_rate"),
            "gdp_volatility": moving_deviation("gdp_growth_rate"),
            "ranking_change": change("ranking"),
            "ranking_normalized": G.ranking_normalized(ranking),
            "gdp_per_capita_proxy": G.per_rank(gdp_bn, ranking),
            "economic_momentum": G.momentum(growth),
            "export_gdp_ratio": G.share_or_zero(F.col("total_exports_usd"), F.col("gdp_value")),
            "export_diversity_score": G.diversity(
                F.col("export_destinations"), F.col("export_products")
            ),
            "years_since_2019": G.years_since_start(F.col("year")),
            "year_squared": F.col("year") * F.col("year"),
            "is_major_economy": G.is_big_economy(gdp_bn),
            "is_emerging_market": G.is_emerging(gdp_bn),
        }
    ).fillna({"gdp_lag_2": 0.0, "gdp_growth_lag_1": 0.0, "ranking_change": 0})
    return (
        drop_without_lag(wide).select("country_code", "country_name", TARGET, *SHORT_FEATURES).dropna()
    )


def long_features(panel: DataFrame, raw_exports: DataFrame) -> DataFrame:
    """38 features of all countries, the target and the keys.

    Other nulls than a missing first lag are left; training fills them with 0.
    """
    base = join_yearly_averages(panel, marts.yearly_averages(raw_exports))
    known = panel.filter(F.col("gdp_value") > 0)
    base = with_category_codes(
        with_year_fraction(base, known), "country_code", "region", "economy_size", panel=known
    )
    gdp, gdp_bn = F.col("gdp_value"), F.col(TARGET)
    growth, ranking = F.col("gdp_growth_rate"), F.col("ranking")
    wide = base.withColumns(
        {
            "year_sin": G.turn_sin(F.col("year_normalized")),
            "year_cos": G.turn_cos(F.col("year_normalized")),
            "gdp_lag_1": before("gdp_value"),
            "gdp_lag_2": before("gdp_value", 2),
            "gdp_growth_lag_1": before("gdp_growth_rate"),
            "ranking_lag_1": before("ranking"),
            "gdp_rolling_mean_3": moving_average("gdp_value"),
            "gdp_rolling_std_3": moving_deviation("gdp_value"),
            "growth_rolling_mean_3": moving_average("gdp_growth_rate"),
            "growth_volatility": moving_deviation("gdp_growth_rate"),
            "gdp_change": change("gdp_value"),
            "ranking_change": change("ranking"),
            "gdp_pct_change": relative_change("gdp_value"),
            "gdp_vs_year_mean": gdp / F.avg("gdp_value").over(all_in_year("gdp_value")),
            "ranking_percentile": average_rank_share("ranking"),
            "gdp_percentile": average_rank_share("gdp_value"),
            "region_gdp_interaction": F.avg("gdp_value").over(in_region()),
            "gdp_per_capita_proxy": G.per_rank(gdp_bn, ranking),
            "economic_stability": G.stability(growth),
            "gdp_local_fob_ratio": G.share_or_zero(gdp_bn, F.col("local_avg_fob")),
            "gdp_export_diversity": gdp_bn * F.col("local_unique_destinations"),
            "export_intensity": G.export_intensity(F.col("local_export_records"), gdp_bn),
            "gdp_growth_ranking_interaction": G.per_rank(growth, ranking),
        }
    ).withColumns(
        {
            "growth_momentum": growth * F.col("gdp_vs_year_mean"),
            # The same number under the two names that the feature list holds.
            "gdp_volatility": F.col("gdp_rolling_std_3"),
        }
    )
    return wide.filter(F.col("gdp_lag_1").isNotNull()).select(
        "country_code", "country_name", TARGET, *LONG_FEATURES
    )
