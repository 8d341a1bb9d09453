"""The training job: feature table to registered model and predictions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from ..constants import LAGGED_FEATURES
from ..operators import features as feature_tables
from ..operators import learning
from ..sources.tables import append_table, read_table, write_table
from .exports import current


def run(
    spark: SparkSession, warehouse: str, run_at: datetime, features=LAGGED_FEATURES,
    grid: dict | None = None, **settings,
) -> str:
    """Train on the stored tables; with a grid, tune first. Returns the version.

    A model that fails the deployment check is an error and is not registered.
    """
    panel = read_table(spark, f"{warehouse}/gdp_panel")
    exports = current(spark, warehouse, "exports")
    write_table(feature_tables.short_features(panel, exports), f"{warehouse}/training_table")
    table = read_table(spark, f"{warehouse}/training_table")
    if grid:
        tuned = learning.tune(learning.split(table)[0], features, grid, **settings)
        settings = {**settings, **learning.best_settings(tuned)}
    result = learning.train(table, features, **settings)
    models = f"{warehouse}/models"
    version = learning.save(result, models, run_at, settings)
    metadata = learning.read_metadata(spark, models, version)
    check = learning.check_deployment(f"{models}/model_{version}", table).first()
    if check.validation_status != "PASSED":
        raise RuntimeError(f"model {version} gives no finite prediction; it is not registered")
    append_table(learning.registry_row(metadata, table), f"{warehouse}/model_registry")
    predictions = learning.predict(result.model, table)
    append_table(
        learning.as_model_predictions(predictions, version, run_at),
        f"{warehouse}/model_predictions",
    )
    return version
