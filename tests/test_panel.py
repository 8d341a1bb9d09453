"""Panel, features and reports on hand-made rows."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tradepanel.functions import gdp as G
from tradepanel.operators import features as X
from tradepanel.operators import panel as P
from tradepanel.operators import reports as R


@pytest.fixture(scope="module")
def small(spark):
    rows = [
        ("USA", "United States", 2020, 100e9), ("USA", "United States", 2021, 110e9),
        ("USA", "United States", 2022, 99e9), ("CHL", "Chile", 2020, 50e9),
        ("CHL", "Chile", 2021, 110e9), ("XKX", "Kosovo", 2021, 1e9),
        ("WLD", "World", 2020, 9e13), ("PER", "Peru", 2020, None), ("PER", "Peru", 2021, -1.0),
        (None, "Nowhere", 2020, 5.0),
    ]
    flat = spark.createDataFrame(
        rows, "country_code STRING, country_name STRING, year INT, gdp_value DOUBLE"
    )
    return P.build_panel(flat).cache()


def by_key(df, column):
    return {(r.country_code, r.year): r[column] for r in df.collect()}


def test_only_countries_with_gdp(small):
    assert set(by_key(small, "year")) == {
        ("USA", 2020), ("USA", 2021), ("USA", 2022), ("CHL", 2020), ("CHL", 2021), ("XKX", 2021)
    }


def test_dense_rank_shares_places(small):
    rank = by_key(small, "ranking")
    assert [rank["USA", 2021], rank["CHL", 2021], rank["XKX", 2021]] == [1, 1, 2]


def test_growth_by_country(small):
    growth = by_key(small, "gdp_growth_rate")
    assert growth["USA", 2020] is None and growth["CHL", 2020] is None
    assert growth["USA", 2021] == pytest.approx(10)
    assert growth["USA", 2022] == pytest.approx(-10)


def test_classes(small):
    region, size = by_key(small, "region"), by_key(small, "economy_size")
    assert region["USA", 2020] == "North America" and region["CHL", 2020] == "South America"
    assert region["XKX", 2021] == "Other"
    assert size["USA", 2021] == "Middle" and size["USA", 2022] == "Lower Middle"
    assert size["CHL", 2020] == "Lower Middle" and size["XKX", 2021] == "Small"


def test_logs_are_two(small):
    row = small.filter("country_code = 'XKX'").first()
    assert row.log_gdp == pytest.approx(math.log(1e9)) and row.log10_gdp == pytest.approx(9)


@pytest.mark.parametrize(
    "gdp, size",
    [(5e12, "Major"), (1e12, "Large"), (5e11, "Upper Middle"), (1e11, "Middle"),
     (5e10, "Lower Middle"), (4.99e10, "Small")],
)
def test_economy_sizes(spark, gdp, size):
    assert spark.range(1).select(G.economy_size(F.lit(gdp))).first()[0] == size


@pytest.mark.parametrize("growth, score", [(5.1, 3), (5.0, 2), (2.0, 1), (0.0, 0), (None, 0)])
def test_momentum(spark, growth, score):
    df = spark.createDataFrame([(growth,)], "g DOUBLE")
    assert df.select(G.momentum(F.col("g"))).first()[0] == score


def test_zero_where_the_whole_is_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (1.0, None)], "a DOUBLE, b DOUBLE")
    assert [r[0] for r in df.select(G.share_or_zero(F.col("a"), F.col("b"))).collect()] == [0, 0.25, 0]


def test_lags_and_moving_windows(small):
    df = small.select(
        "country_code", "year", X.before("gdp_value").alias("lag1"),
        X.before("gdp_value", 2).alias("lag2"), X.moving_average("gdp_billion_usd").alias("ma"),
        X.moving_deviation("gdp_billion_usd").alias("sd"), X.change("ranking").alias("change"),
        X.relative_change("gdp_value").alias("ratio"),
    )
    rows = {(r.country_code, r.year): r for r in df.collect()}
    last = rows["USA", 2022]
    assert (last.lag1, last.lag2) == (110e9, 100e9)
    assert last.ma == pytest.approx(103) and last.sd == pytest.approx(6.0827625)
    assert last.change == 0 and last.ratio == pytest.approx(-0.1)
    assert rows["XKX", 2021].sd == 0 and rows["XKX", 2021].lag1 is None


def test_equal_values_share_their_rank(small):
    share = by_key(
        small.select("country_code", "year", X.average_rank_share("gdp_value").alias("s")), "s"
    )
    assert share["XKX", 2021] == pytest.approx(1 / 3)
    assert share["USA", 2021] == share["CHL", 2021] == pytest.approx(2.5 / 3)


def test_year_fraction(small, spark):
    fraction = by_key(X.with_year_fraction(small), "year_normalized")
    assert fraction["USA", 2020] == 0 and fraction["USA", 2021] == 0.5 and fraction["USA", 2022] == 1
    one_year = X.with_year_fraction(small.filter("year = 2021"))
    assert [r.year_normalized for r in one_year.collect()] == [None] * 3


def test_category_codes_are_alphabetical(small):
    codes = by_key(X.with_category_codes(small, "country_code"), "country_code_encoded")
    assert (codes["CHL", 2020], codes["USA", 2020], codes["XKX", 2021]) == (0, 1, 2)


def test_latest_year_and_view(small):
    assert {r.country_code for r in P.latest_year(small).collect()} == {"USA"}
    assert P.gdp_ranking_latest(small).first().country_name == "United States"


def test_filters_of_reports(small):
    assert R.gdp_rankings(small, [2021], ["Chile"]).count() == 1
    assert R.gdp_rankings(small, [], []).count() == small.count()
    assert R.gdp_overview(small, [2021]).first().total_countries == 3
    assert R.gdp_growth_analysis(small).count() == 3
    assert [r.country_name for r in R.top_countries(small, [2020, 2021], 2).collect()] == [
        "Chile", "United States"
    ]
    assert [r.year for r in R.available_years(small).collect()] == [2022, 2021, 2020]


def test_regional_counts(small):
    rows = {r.region: r for r in R.regional_performance(small).collect()}
    assert rows["North America"].country_year_count == 3
    assert rows["North America"].country_count == 1
    shares = R.regional_share(small).agg(F.sum("share")).first()[0]
    assert shares == pytest.approx(1)


def test_quartiles_interpolate(spark):
    df = spark.createDataFrame([(2020, float(v)) for v in (1, 2, 3, 4)], "year INT, gdp_value DOUBLE")
    row = R.gdp_distribution(df).first()
    assert tuple(row) == (2020, 1.0, 1.75, 2.5, 3.25, 4.0)


def test_first_countries_and_rows(small):
    assert {r.country_name for r in R.first_countries(small, 2).collect()} == {"Chile", "Kosovo"}
    assert R.first_rows(small, "country_name", "year", k=1).first().country_name == "Chile"


def test_prediction_validation(spark):
    schema = "absolute_error DOUBLE, percentage_error DOUBLE"
    good = R.prediction_validation(
        spark.createDataFrame([(1.0, 5.0), (2.0, 15.0), (9.0, 60.0)], schema)
    ).first()
    assert (good.predictions_within_10_percent, good.predictions_within_20_percent) == (1, 2)
    assert good.median_absolute_error == 2 and good.is_valid
    assert not R.prediction_validation(spark.createDataFrame([(9.0, 60.0)], schema)).first().is_valid
    assert not R.prediction_validation(spark.createDataFrame([], schema)).first().is_valid


def test_duplicates_and_age(spark):
    df = spark.createDataFrame(
        [("a", 1, date(2025, 1, 1)), ("a", 1, None), ("b", 1, date(2024, 1, 1))],
        "`NUMERO DE ACEPTACION` STRING, ITEM INT, EXPORT_DATE DATE",
    )
    row = R.duplicates_and_age(df, date(2025, 1, 15)).first()
    assert (row.duplicates, row.data_age_days) == (1, 14)


def test_load_since(spark):
    rows = [("f1", datetime(2025, 1, 1)), ("f2", datetime(2025, 2, 1)), ("f2", datetime(2025, 2, 2))]
    df = spark.createDataFrame(rows, "SOURCE_FILE STRING, EXTRACTION_DATE TIMESTAMP")
    row = R.export_load_statistics(df, date(2025, 2, 1)).first()
    assert (row.total_records, row.total_files) == (2, 1)


def test_completeness_of_empty_table(spark):
    empty = spark.createDataFrame([], "gdp_value DOUBLE")
    exports = spark.createDataFrame([(1.0,), (None,)], "FOB_CLEAN DOUBLE")
    rows = {r.dataset: r.completeness for r in R.completeness(empty, exports).collect()}
    assert rows == {"gdp": None, "exports": 50.0}
