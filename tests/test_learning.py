"""Split, fit, score, register; and the three jobs from files to predictions."""

import json
import math
from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tradepanel.constants import BOOSTING, LAGGED_FEATURES, LONG_FEATURES, SHORT_FEATURES, TARGET
from tradepanel.operators import learning as L
from tradepanel.operators import reports
from tradepanel.plans import exports as export_job
from tradepanel.plans import gdp as gdp_job
from tradepanel.plans import training as training_job
from tradepanel.plans.dashboard import Dashboard
from tradepanel.sources import tables as S

AT = datetime(2025, 1, 15, 6, 0, 0)
SMALL = {"maxIter": 5, "maxDepth": 3}


@pytest.fixture(scope="module")
def table(tables):
    return S.stored(tables.short_features(), "training")


@pytest.fixture(scope="module")
def trained(table):
    return L.train(table, **SMALL)


def test_feature_lists():
    assert len(set(SHORT_FEATURES)) == 22 and len(set(LONG_FEATURES)) == 38
    assert TARGET not in LAGGED_FEATURES
    assert {"gdp_ma_3yr", "ranking", "gdp_per_capita_proxy"}.isdisjoint(LAGGED_FEATURES)


def test_default_settings():
    model = L.booster()
    assert (model.getMaxIter(), model.getStepSize(), model.getMaxDepth(), model.getSeed()) == (
        100, 0.1, 5, 42
    )
    assert len(L.full_grid(model)) == 162 and BOOSTING["seed"] == 42


def test_split_is_whole_and_repeatable(spark):
    df = spark.range(10_000).select(F.col("id").cast("string").alias("country_code"), F.lit(1).alias("year"))
    train, test = L.split(df)
    assert train.count() + test.count() == 10_000
    assert 0.77 < train.count() / 10_000 < 0.83
    again = L.split(df.repartition(7))[0]
    assert again.exceptAll(train).isEmpty() and train.exceptAll(again).isEmpty()


def test_scaling_matches_plain_statistics(table):
    row = L.scaling_table(table, ["year", "gdp_lag_1"]).filter("feature = 'gdp_lag_1'").first()
    wanted = table.agg(F.avg("gdp_lag_1"), F.stddev_samp("gdp_lag_1")).first()
    assert row.mean == pytest.approx(wanted[0]) and row.deviation == pytest.approx(wanted[1])


def test_indexer_keeps_unseen_labels(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "x STRING")
    model = L.category_indexer(df, "x")
    seen = {r.x: r.x_encoded for r in model.transform(df).collect()}
    assert seen == {"a": 0, "b": 1, "c": 2}
    other = spark.createDataFrame([("z",)], "x STRING")
    assert model.transform(other).first().x_encoded == 3


def test_metrics_match_the_evaluator(trained):
    predictions = trained.model.transform(trained.test)
    row = L.metrics(predictions).first()
    assert row.r2 == pytest.approx(L.evaluator("r2").evaluate(predictions))
    assert row.rmse == pytest.approx(L.evaluator("rmse").evaluate(predictions))
    assert row.mae == pytest.approx(L.evaluator("mae").evaluate(predictions))


def test_importances_add_up(trained, spark):
    table = L.importances(trained.model, spark)
    assert table.count() == len(LAGGED_FEATURES)
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    top = [r.importance for r in L.top_features(table, 3).collect()]
    assert top == sorted(top, reverse=True) and len(top) == 3


def test_predictions_have_their_errors(trained):
    for row in L.predict(trained.model, trained.test).collect():
        assert math.isfinite(row.predicted_gdp)
        assert row.absolute_error == abs(row.actual_gdp - row.predicted_gdp)
        assert row.percentage_error == pytest.approx(row.absolute_error / row.actual_gdp * 100)


def test_rows_with_missing_features_are_predicted(trained, table):
    name = LAGGED_FEATURES[0]
    holes = table.withColumn(name, F.when(F.col("year") % 2 == 0, F.col(name)))
    zeros = table.withColumn(name, F.when(F.col("year") % 2 == 0, F.col(name)).otherwise(F.lit(0)))
    found, wanted = (sorted(L.predict(trained.model, x).collect()) for x in (holes, zeros))
    assert len(found) == table.count() and found == wanted


def test_training_needs_enough_rows(table):
    with pytest.raises(ValueError):
        L.train(table.limit(49), **SMALL)


def test_saved_model_predicts_the_same(trained, spark, tmp_path):
    version = L.save(trained, str(tmp_path), AT, SMALL)
    assert version == "20250115_060000"
    loaded = PipelineModel.load(f"{tmp_path}/model_{version}")
    wanted = trained.model.transform(trained.test).select("country_code", "year", "prediction")
    found = loaded.transform(trained.test).select("country_code", "year", "prediction")
    assert sorted(wanted.collect()) == sorted(found.collect())
    metadata = L.read_metadata(spark, str(tmp_path), version).first()
    assert metadata.training_samples == trained.train.count()
    assert metadata.test_samples == trained.test.count()
    assert metadata.feature_names == list(LAGGED_FEATURES)
    assert metadata.hyperparameters["maxIter"] == "5"
    assert L.read_importances(spark, str(tmp_path), version).count() == len(LAGGED_FEATURES)
    check = L.check_deployment(f"{tmp_path}/model_{version}", trained.test).first()
    assert check.validation_status == "PASSED"


def test_one_active_version_per_type(spark):
    rows = [("gdp_regression", f"v{i}", AT + timedelta(days=i)) for i in range(3)] + [("other", "o1", AT)]
    df = spark.createDataFrame(rows, "model_type STRING, model_version STRING, training_date TIMESTAMP")
    active = {r.model_type: r.model_version for r in L.with_active(df).filter("is_active").collect()}
    assert active == {"gdp_regression": "v2", "other": "o1"}
    assert L.active_model(L.empty_registry(spark)).isEmpty()


def test_tuning_table(table, spark):
    tuned = L.tune(table, LAGGED_FEATURES, {"maxIter": (2, 4), "maxDepth": (2,)}, folds=2)
    rows = L.tuning_table(tuned, spark).collect()
    assert {r.settings["maxIter"] for r in rows} == {2, 4}
    best = max(rows, key=lambda r: r.mean_r2)
    assert L.best_settings(tuned)["maxIter"] == best.settings["maxIter"]


def test_jobs_from_files_to_predictions(spark, tables, tmp_path, monkeypatch):
    from tradepanel.catalog.files import landed

    warehouse = f"{tmp_path}/warehouse"
    checks = {r.check_id: r.passed for r in export_job.run(spark, landed(tables), warehouse, AT).collect()}
    assert checks == {"DQ1": True, "DQ2": True, "DQ3": True, "DQ9": True}
    assert S.read_table(spark, f"{warehouse}/exports").count() == tables.clean().count()

    pages = tmp_path / "pages"
    pages.mkdir()
    for year in range(2018, 2025):
        records = [
            {"countryiso3code": code, "date": str(year), "value": 2e10 * (i + 1) * 1.03 ** (year - 2018),
             "country": {"id": code, "value": f"Country {code}"},
             "indicator": {"id": "NY.GDP.MKTP.CD", "value": "GDP (current US$)"}}
            for i, code in enumerate(("USA", "CHL", "PER", "DEU", "FRA", "JPN", "CHN", "IND",
                                      "BRA", "MEX", "ARG", "COL", "WLD"))
        ]
        (pages / f"{year}.json").write_text(json.dumps([{}, records]))
    for _ in range(2):
        checks = {r.check_id: r for r in gdp_job.run(spark, str(pages), warehouse, AT).collect()}
    assert checks["DQ4"].value == 36 and not checks["DQ4"].passed
    assert checks["DQ7"].value == 10 and checks["DQ8"].value == 0

    board = Dashboard(spark, warehouse)
    assert board.get_active_model_info().isEmpty()
    with pytest.raises(LookupError):
        board.get_feature_importance()
    version = training_job.run(spark, warehouse, AT, grid={"maxDepth": (2, 3)}, maxIter=3)
    assert board.get_feature_importance(3).count() == 3
    assert {r.metric for r in board.get_model_performance_metrics().collect()} >= {"r2_score", "mae"}
    made = board.generate_predictions(["Country CHL"], [2023, 2024])
    assert made.count() == 2 and board.validate_predictions(made).first().total_predictions == 2
    types = dict(board.exports.dtypes)
    assert (types["YEAR"], types["MES"], types["DIA"]) == ("int", "int", "int")
    active = board.get_active_model_info().first()
    assert (active.model_version, active.data_period) == (version, "2020-2024")
    failed = spark.createDataFrame([("FAILED",)], "validation_status STRING")
    monkeypatch.setattr(L, "check_deployment", lambda path, table: failed)
    with pytest.raises(RuntimeError):
        training_job.run(spark, warehouse, AT + timedelta(days=1), maxIter=1)
    assert board.get_active_model_info().first().model_version == version
    assert board.get_predictions().count() == 60
    assert board.get_predictions([2024], ["CHL"]).count() == 1
    assert [r.year for r in board.get_available_years().collect()][:2] == [2024, 2023]
    assert board.get_gdp_overview([2024]).first().total_countries == 12
    assert board.get_exports_by_country([2020]).count() == 25
    assert board.get_economic_correlations([2023], ["Country CHL"]).count() == 1
    assert board.get_economic_indicators([2023]).count() == 12
    assert board.get_recent_updates().count() == 2
    assert board.get_data_quality_checks().count() == 9
    assert board.get_data_quality_metrics().count() == 2
    assert not board.get_data_quality_issues().isEmpty()
    assert board.get_gdp_quality_issues().isEmpty()
    assert board.get_data_lineage().count() > 1
    assert board.get_duplicates_and_age(AT.date()).first().duplicates >= 0
    for name in (
        "get_available_countries", "get_local_data_overview", "get_gdp_by_year",
        "get_gdp_distribution", "get_local_data_trends", "get_gdp_rankings", "get_top_countries",
        "get_gdp_growth_analysis", "get_regional_performance", "get_regional_share",
        "get_export_data_summary", "get_local_data_summary", "get_local_value_trends",
        "get_category_performance", "get_monthly_patterns",
    ):
        assert not getattr(board, name)().isEmpty(), name


def test_validation_of_predictions(trained):
    row = reports.prediction_validation(L.predict(trained.model, trained.train)).first()
    assert row.total_predictions == trained.train.count() and row.is_valid is not None
