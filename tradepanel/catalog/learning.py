"""Training and what it leaves behind."""

from datetime import timedelta

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..constants import LAGGED_FEATURES, SHORT_FEATURES, TARGET
from ..operators import features, reports
from ..operators import learning as L
from ..session import new_folder
from ..sources.tables import stored
from .adapter import RUN_AT
from .aggregates import LAST_YEAR_AS_FORECAST
from .features import SHORT_SQL, comparable
from .registry import query


@query(
    "m1_assembled_features",
    f"""SELECT {", ".join(
        n if n == "country_code" else f"CAST({n} AS DOUBLE) AS {n}"
        for n in ("country_code", *SHORT_FEATURES))} FROM ({SHORT_SQL})""",
)
def m1(t):
    """The elements of the assembled vector, under the names of the features."""
    assembled = L.assembler(SHORT_FEATURES).transform(t.short_features())
    rows = assembled.select("country_code", vector_to_array("features").alias("f"))
    return comparable(
        rows.select(
            "country_code", *[F.col("f")[i].alias(n) for i, n in enumerate(SHORT_FEATURES)]
        )
    )


def of_features(function: str) -> str:
    values = [f"{function}(CAST({name} AS DOUBLE))" for name in SHORT_FEATURES]
    return ", ".join(f"CASE WHEN {x} >= 1e9 THEN round({x} / 1e9, 6) ELSE round({x}, 4) END" for x in values)


@query(
    "m2_scaling",
    f"""SELECT unnest([{", ".join(f"'{name}'" for name in SHORT_FEATURES)}]) AS feature,
          unnest(means) AS mean, unnest(deviations) AS deviation
        FROM (SELECT [{of_features("avg")}] AS means, [{of_features("stddev_samp")}] AS deviations
              FROM ({SHORT_SQL}))""",
)
def m2(t):
    """Of the features as ``m17_short_features`` shows them; large numbers in billions."""
    table = L.scaling_table(stored(comparable(t.short_features()), "features"), SHORT_FEATURES)
    shown = lambda name: F.when(F.col(name) >= 1e9, F.round(F.col(name) / 1e9, 6)).otherwise(F.round(name, 4))
    return table.withColumns({name: shown(name) for name in ("mean", "deviation")})


CODED = ("country_code", "region", "economy_size")


@query(
    "m3_category_codes",
    """SELECT country_code, region, economy_size, year,
       CAST(dense_rank() OVER (ORDER BY country_code) - 1 AS DOUBLE) AS country_code_encoded,
       CAST(dense_rank() OVER (ORDER BY region) - 1 AS DOUBLE) AS region_encoded,
       CAST(dense_rank() OVER (ORDER BY economy_size) - 1 AS DOUBLE) AS economy_size_encoded
       FROM panel""",
)
def m3(t):
    rows = t.stored_panel().select(*CODED, "year")
    return L.category_indexer(rows, *CODED).transform(rows)


def scored(t):
    result = t.trained()
    return result.model.transform(result.test)


@query("m4_boosted_predictions")
def m4(t):
    return scored(t).select("country_code", "year", TARGET, "prediction")


@query("m5_training_steps")
def m5(t):
    """The fitted steps applied one after the other equal the fitted whole."""
    result = t.trained()
    df = result.test
    for step in result.model.stages:
        df = step.transform(df)
    return df.select("country_code", "year", vector_to_array("scaled_features").alias("scaled"),
                     "prediction")


@query("m6_split")
def m6(t):
    train, test = L.split(t.short_features())
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    ).select("country_code", "year", "part")


@query("m7_metrics")
def m7(t):
    result = t.trained()
    parts = {"train": result.train, "test": result.test}
    rows = [
        L.metrics(result.model.transform(df)).withColumn("part", F.lit(part))
        for part, df in parts.items()
    ]
    return rows[0].unionByName(rows[1])


@query("m8_tuning")
def m8(t):
    table = stored(t.short_features(), "training")
    grid = {"maxIter": (5, 10), "maxDepth": (2, 4)}
    return L.tuning_table(L.tune(L.split(table)[0], LAGGED_FEATURES, grid), t.spark)


@query("m9_cross_validation")
def m9(t):
    table = stored(t.short_features(), "training")
    return L.cross_validate(L.split(table)[0], LAGGED_FEATURES, maxIter=10, maxDepth=3)


@query("m10_importances")
def m10(t):
    return L.importances(t.trained().model, t.spark)


@query("o4_top_importances")
def o4(t):
    return L.top_features(L.importances(t.trained().model, t.spark), 5)


def saved(t):
    folder = new_folder(t.spark, "models")
    return folder, L.save(t.trained(), folder, RUN_AT)


@query("m11_saved_model")
def m11(t):
    folder, version = saved(t)
    return L.read_metadata(t.spark, folder, version).select(
        "model_name", "model_version", "model_type", "training_samples", "test_samples",
        F.size("feature_names").alias("features"),
        F.element_at("performance_metrics", "r2_score").alias("r2_score"),
    )


@query("m12_registry_row")
def m12(t):
    folder, version = saved(t)
    result = t.trained()
    table = result.train.unionByName(result.test)
    return L.registry_row(L.read_metadata(t.spark, folder, version), table)


@query("m13_deployment_check")
def m13(t):
    folder, version = saved(t)
    return L.check_deployment(f"{folder}/model_{version}", t.trained().test)


@query("m14_predictions")
def m14(t):
    result = t.trained()
    table = result.train.unionByName(result.test)
    predictions = L.predict(result.model, table)
    return L.as_model_predictions(predictions, L.version_of(RUN_AT), RUN_AT)


@query("m14_prediction_validation")
def m14_validation(t):
    result = t.trained()
    return reports.prediction_validation(L.predict(result.model, result.test))


@query("m15_active_model")
def m15(t):
    """Two versions are saved and registered; the later one is active."""
    result = t.trained()
    folder = new_folder(t.spark, "models")
    table = result.train.unionByName(result.test)
    rows = [
        L.registry_row(L.read_metadata(t.spark, folder, L.save(result, folder, at)), table)
        for at in (RUN_AT - timedelta(days=30), RUN_AT)
    ]
    return L.active_model(rows[0].unionByName(rows[1]))


@query("s26_validation_sample")
def s26(t):
    result = t.trained()
    return L.validation_sample(L.predict(result.model, result.test))


@query(
    "w17_active_versions",
    """SELECT model_type, model_version, is_active FROM (
         SELECT region AS model_type, model_version,
           row_number() OVER (PARTITION BY region ORDER BY model_version DESC) = 1 AS is_active
         FROM (SELECT DISTINCT region, 'v' || year AS model_version FROM panel))""",
)
def w17(t):
    """A registry with one version per year and, as types, the regions."""
    registry = t.panel().select(
        F.col("region").alias("model_type"),
        F.concat(F.lit("v"), F.col("year").cast("string")).alias("model_version"),
        F.make_timestamp("year", F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)).alias(
            "training_date"
        ),
    ).distinct()
    return L.with_active(registry).select("model_type", "model_version", "is_active")


# The queries above depend on trees, which no SQL grows. Those below run the same
# operators on a forecast that SQL can make: GDP stays as it was the year before.


def forecast(t):
    return t.panel().select(
        "country_code", "country_name", "year", F.col("gdp_billion_usd").alias(TARGET),
        features.before("gdp_billion_usd").alias("prediction"),
    ).filter(F.col("prediction").isNotNull())


KNOWN_FORECAST = f"(SELECT * FROM ({LAST_YEAR_AS_FORECAST}) WHERE predicted_gdp IS NOT NULL)"


@query(
    "m7_metrics_of_forecast",
    f"""SELECT round(1 - sum((actual_gdp - predicted_gdp) ** 2)
          / (var_pop(actual_gdp) * count(*)), 9) AS r2,
        round(sqrt(avg((actual_gdp - predicted_gdp) ** 2)), 6) AS rmse,
        round(avg(abs(actual_gdp - predicted_gdp)), 6) AS mae, count(*) AS samples
        FROM {KNOWN_FORECAST}""",
)
def m7_forecast(t):
    found = L.metrics(forecast(t))
    return reports.rounded(reports.rounded(found, "r2", places=9), "rmse", "mae", places=6)


@query(
    "m14_errors_of_forecast",
    f"""SELECT country_code, year, actual_gdp, predicted_gdp,
        abs(actual_gdp - predicted_gdp) AS absolute_error,
        abs(actual_gdp - predicted_gdp) / actual_gdp * 100 AS percentage_error
        FROM {KNOWN_FORECAST}""",
)
def m14_forecast(t):
    rows = forecast(t).withColumnsRenamed({TARGET: "actual_gdp", "prediction": "predicted_gdp"})
    return L.with_errors(rows).drop("country_name")


@query(
    "s26_sample_of_forecast",
    f"""SELECT country_code, year, predicted_gdp FROM {KNOWN_FORECAST}
        ORDER BY country_code, year LIMIT 20""",
)
def s26_forecast(t):
    return L.validation_sample(forecast(t)).select(
        "country_code", "year", F.col("prediction").alias("predicted_gdp")
    )


@query(
    "o4_top_of_table",
    """SELECT country_code AS feature, max(gdp_value) AS importance FROM panel
       GROUP BY country_code ORDER BY importance DESC, feature LIMIT 10""",
)
def o4_table(t):
    return L.top_features(
        t.panel().groupBy(F.col("country_code").alias("feature")).agg(
            F.max("gdp_value").alias("importance")
        )
    )
