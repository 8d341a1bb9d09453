"""Boosted regression on the training tables: split, fit, tune, score, register."""

from __future__ import annotations

import math
from datetime import datetime
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    StringIndexerModel,
    SQLTransformer,
    VectorAssembler,
)
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..constants import (
    BOOSTING,
    FULL_GRID,
    LAGGED_FEATURES,
    MODEL_NAME,
    MODEL_TYPE,
    TARGET,
)
from ..schemas import IMPORTANCES, MODEL_METADATA, MODEL_REGISTRY
from ..sources.tables import read_json, require_rows, stored, write_json

KEY = ("country_code", "year")
SMALL_GRID = {"maxIter": (10, 20), "maxDepth": (3, 5)}


def split(df: DataFrame, *key: str, tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """M6: about 80/20 by a hash of the key, the same on every run and cluster."""
    bucket = F.pmod(F.xxhash64(*(key or KEY)), F.lit(10))
    return df.filter(bucket < tenths), df.filter(bucket >= tenths)


def assembler(features) -> VectorAssembler:
    """M1: each feature once. A missing value is an error: no row is left out."""
    return VectorAssembler(
        inputCols=list(dict.fromkeys(features)), outputCol="features", handleInvalid="error"
    )


def filler(features) -> SQLTransformer:
    """M1: missing features count as 0, in training, tuning and scoring alike."""
    names = [f"`{name}`" for name in dict.fromkeys(features)]
    filled = [f"coalesce(nanvl(double({name}), 0), 0) AS {name}" for name in names]
    return SQLTransformer(
        statement=f"SELECT * EXCEPT ({', '.join(names)}), {', '.join(filled)} FROM __THIS__"
    )


def scaler() -> StandardScaler:
    """M2."""
    return StandardScaler(
        inputCol="features", outputCol="scaled_features", withMean=True, withStd=True
    )


def scaling(df: DataFrame, features) -> StandardScalerModel:
    return scaler().fit(assembler(features).transform(filler(features).transform(df)))


def scaling_table(df: DataFrame, features) -> DataFrame:
    """M2: mean and sample deviation of each feature as rows."""
    model = scaling(df, features)
    rows = zip(dict.fromkeys(features), map(float, model.mean), map(float, model.std))
    return df.sparkSession.createDataFrame(
        list(rows), "feature STRING, mean DOUBLE, deviation DOUBLE"
    )


def category_indexer(df: DataFrame, *columns: str) -> StringIndexerModel:
    """M3: alphabetical codes from 0; labels not seen before get a code of their own."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{name}_encoded" for name in columns],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    ).fit(df)


def booster(**settings) -> GBTRegressor:
    """M4."""
    return GBTRegressor(
        featuresCol="scaled_features",
        labelCol=TARGET,
        predictionCol="prediction",
        **{**BOOSTING, **settings},
    )


def regression(features, **settings) -> Pipeline:
    """M5: one object holds the feature list, the filling, the scaling and the trees."""
    return Pipeline(stages=[filler(features), assembler(features), scaler(), booster(**settings)])


def evaluator(metric: str = "r2") -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=TARGET, predictionCol="prediction", metricName=metric)


def metrics(predictions: DataFrame) -> DataFrame:
    """M7: R², RMSE and MAE in one pass."""
    label, error = F.col(TARGET), F.col(TARGET) - F.col("prediction")
    squared = F.sum(error * error)
    return predictions.agg(
        (1 - F.try_divide(squared, F.var_pop(label) * F.count(label))).alias("r2"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.count("*").alias("samples"),
    )


def importances(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """One row per feature, as many as the feature list is long."""
    names = model.stages[1].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(name, float(weight)) for name, weight in zip(names, weights)], IMPORTANCES
    )


def top_features(table: DataFrame, k: int = 10) -> DataFrame:
    """O4."""
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def grid(model: GBTRegressor, settings: dict) -> list:
    """M8: every combination of the settings."""
    builder = ParamGridBuilder()
    for name, values in settings.items():
        builder = builder.addGrid(getattr(model, name), list(values))
    return builder.build()


def full_grid(model: GBTRegressor) -> list:
    return grid(model, FULL_GRID)


def tune(
    train: DataFrame, features, settings=None, folds: int = 3, parallelism: int = 4, **fixed
) -> CrossValidatorModel:
    """M8: cross-validated search. The scaling is fitted within each fold."""
    steps = regression(features, **fixed)
    return CrossValidator(
        estimator=steps,
        estimatorParamMaps=grid(steps.getStages()[-1], settings or SMALL_GRID),
        evaluator=evaluator("r2"),
        numFolds=folds,
        parallelism=parallelism,
        seed=BOOSTING["seed"],
    ).fit(train)


def tuning_table(tuned: CrossValidatorModel, spark: SparkSession) -> DataFrame:
    """M8, M9: mean R², and its spread of two deviations, per combination."""
    rows = []
    for params, average, deviation in zip(
        tuned.getEstimatorParamMaps(), tuned.avgMetrics, tuned.stdMetrics
    ):
        chosen = {param.name: float(value) for param, value in params.items()}
        rows.append((chosen, float(average), 2 * float(deviation)))
    return spark.createDataFrame(
        rows, "settings MAP<STRING, DOUBLE>, mean_r2 DOUBLE, two_deviations DOUBLE"
    )


def best_settings(tuned: CrossValidatorModel) -> dict:
    """M8: the combination with the highest mean R²."""
    best = max(range(len(tuned.avgMetrics)), key=lambda i: tuned.avgMetrics[i])
    return {p.name: v for p, v in tuned.getEstimatorParamMaps()[best].items()}


def cross_validate(train: DataFrame, features, folds: int = 5, **settings) -> DataFrame:
    """M9: the chosen settings alone, over five folds."""
    one = {name: (value,) for name, value in {**BOOSTING, **settings}.items() if name != "seed"}
    return tuning_table(tune(train, features, one, folds), train.sparkSession)


class Trained(NamedTuple):
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    features: tuple[str, ...]


def train(table: DataFrame, features=LAGGED_FEATURES, **settings) -> Trained:
    """Fit on a written copy of the training table.

    Boosting reads its input once per tree level, so the features are computed
    once and stored. Missing features other than the first lag count as 0. By
    default only features from before the predicted year are used.
    """
    table = require_rows(stored(table.fillna(0), "training"))
    fit_on, test = split(table)
    return Trained(regression(features, **settings).fit(fit_on), fit_on, test, tuple(features))


def with_errors(predictions: DataFrame) -> DataFrame:
    """Absolute and percent error of each prediction."""
    error = F.abs(F.col("actual_gdp") - F.col("predicted_gdp"))
    return predictions.withColumns(
        {
            "absolute_error": error,
            "percentage_error": F.try_divide(error, F.col("actual_gdp")) * 100,
        }
    )


def predict(model: PipelineModel, table: DataFrame, countries=None, years=None) -> DataFrame:
    """Predicted and actual GDP in billions, for the chosen rows."""
    if countries:
        table = table.filter(F.col("country_name").isin(*countries))
    if years:
        table = table.filter(F.col("year").isin(*years))
    scored = model.transform(table).select(
        "country_code", "country_name", "year",
        F.col(TARGET).alias("actual_gdp"), F.col("prediction").alias("predicted_gdp"),
    )
    return with_errors(scored)


def as_model_predictions(predictions: DataFrame, version: str, at: datetime) -> DataFrame:
    """The rows of the predictions table. Values are dollars, the error percent."""
    def dollars(name):
        return F.col(name) * F.lit(1e9)

    return predictions.select(
        F.lit(version).alias("model_version"), F.lit(MODEL_TYPE).alias("model_type"),
        "country_code", "year", F.lit(None).cast("int").alias("month"),
        F.lit("gdp").alias("category"), dollars("predicted_gdp").alias("predicted_value"),
        dollars("actual_gdp").alias("actual_value"),
        F.col("percentage_error").alias("prediction_error"),
        F.lit(at).alias("prediction_date"),
    )


def validation_sample(predictions: DataFrame, k: int = 20) -> DataFrame:
    """S26."""
    return predictions.orderBy("country_code", "year").limit(k)


def version_of(at: datetime) -> str:
    return f"{at:%Y%m%d_%H%M%S}"


def save(result: Trained, folder: str, at: datetime, settings: dict | None = None) -> str:
    """Model, importances, metadata and sample under one version."""
    spark = result.train.sparkSession
    version = version_of(at)
    path = f"{folder}/model_{version}"
    result.model.write().save(path)
    write_json(importances(result.model, spark), f"{folder}/feature_importance_{version}")
    test, fitted = (
        metrics(result.model.transform(part)).first() for part in (result.test, result.train)
    )
    # A metric without a value, as on an empty test set, is left out.
    named = {
        "r2_score": test.r2, "rmse": test.rmse, "mae": test.mae,
        "train_r2": fitted.r2, "train_rmse": fitted.rmse, "train_mae": fitted.mae,
    }
    row = (
        MODEL_NAME, version, MODEL_TYPE, at.isoformat(), list(result.features),
        {name: value for name, value in named.items() if value is not None},
        fitted.samples, test.samples,
        {name: str(value) for name, value in {**BOOSTING, **(settings or {})}.items()}, path,
    )
    write_json(
        spark.createDataFrame([row], MODEL_METADATA), f"{folder}/model_metadata_{version}"
    )
    sample = validation_sample(predict(result.model, result.test))
    write_json(sample, f"{folder}/sample_predictions_{version}")
    return version


def registry_row(metadata: DataFrame, table: DataFrame) -> DataFrame:
    """What the registry keeps of one training run, with the years of its table."""
    countries = table.agg(F.countDistinct("country_code")).scalar()
    period = table.agg(F.concat_ws("-", F.min("year"), F.max("year"))).scalar()
    return metadata.select(
        "model_name", "model_version", "model_type",
        F.to_timestamp("training_date").alias("training_date"),
        F.element_at("performance_metrics", "r2_score").alias("accuracy_score"),
        "feature_names", "model_path", period.alias("data_period"),
        countries.alias("countries_count"), "training_samples", "test_samples",
    )


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MODEL_REGISTRY)


def with_active(registry: DataFrame) -> DataFrame:
    """The newest version of each type is active. The registry is only ever
    appended to; what is active follows from it."""
    newest = Window.partitionBy("model_type").orderBy(
        F.desc("training_date"), F.desc("model_version")
    )
    return registry.withColumn("is_active", F.row_number().over(newest) == 1)


def active_model(registry: DataFrame, model_type: str = MODEL_TYPE) -> DataFrame:
    """The active version and its measured score; no row if there is none."""
    return with_active(registry).filter(F.col("is_active") & (F.col("model_type") == model_type))


def read_metadata(spark: SparkSession, folder: str, version: str) -> DataFrame:
    return read_json(spark, f"{folder}/model_metadata_{version}", MODEL_METADATA)


def read_importances(spark: SparkSession, folder: str, version: str) -> DataFrame:
    return read_json(spark, f"{folder}/feature_importance_{version}", IMPORTANCES)


def reported_metrics(metadata: DataFrame) -> DataFrame:
    """The measured scores of a version, one row per metric."""
    return metadata.select("model_version", F.explode("performance_metrics").alias("metric", "value"))


def check_deployment(path: str, table: DataFrame) -> DataFrame:
    """The saved model can be loaded and gives a finite prediction."""
    model = PipelineModel.load(path)
    one = table.orderBy(*KEY).limit(1)
    scored = model.transform(one).select("prediction").first()
    ok = scored is not None and math.isfinite(scored.prediction)
    status = "PASSED" if ok else "FAILED"
    return table.sparkSession.createDataFrame(
        [(path, status, scored.prediction if ok else None)],
        "model_path STRING, validation_status STRING, test_prediction_value DOUBLE",
    )
