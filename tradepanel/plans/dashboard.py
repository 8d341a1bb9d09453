"""The dashboard's questions over the stored tables, under their usual names."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators import learning, marts, quality, reports
from ..sources.files import last_update
from ..sources.tables import read_table
from .exports import current


class Dashboard:
    """Every method returns a DataFrame. Empty lists of years or countries mean all."""

    def __init__(self, spark: SparkSession, warehouse: str):
        self.spark = spark
        self.warehouse = warehouse

    def _table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.warehouse}/{name}")

    @property
    def panel(self) -> DataFrame:
        return self._table("gdp_panel")

    @property
    def exports(self) -> DataFrame:
        return current(self.spark, self.warehouse, "exports")

    def get_available_years(self):
        return reports.available_years(self.panel)

    def get_available_countries(self):
        return reports.available_countries(self.panel)

    def get_gdp_overview(self, years=None):
        return reports.gdp_overview(self.panel, years)

    get_worldbank_overview = get_gdp_overview

    def get_local_data_overview(self, years=None):
        return reports.export_overview(self.exports, years)

    def get_gdp_by_year(self, years=None):
        return reports.gdp_by_year(self.panel, years)

    def get_gdp_distribution(self, years=None):
        return reports.gdp_distribution(self.panel, years)

    def get_local_data_trends(self, years=None):
        return reports.export_trend(self.exports, years)

    def get_recent_updates(self):
        sources = {"gdp": "gdp_panel", "exports": "exports"}
        return last_update(self.spark, {k: f"{self.warehouse}/{v}" for k, v in sources.items()})

    def get_gdp_rankings(self, years=None, countries=None):
        return reports.gdp_rankings(self.panel, years, countries)

    def get_top_countries(self, years=None, k=10):
        return reports.top_countries(self.panel, years, k)

    def get_gdp_growth_analysis(self, years=None, countries=None):
        return reports.gdp_growth_analysis(self.panel, years, countries)

    def get_regional_performance(self, years=None):
        return reports.regional_performance(self.panel, years)

    def get_regional_share(self, years=None):
        return reports.regional_share(self.panel, years)

    def get_export_data_summary(self, years=None):
        return reports.export_data_summary(self.exports, years)

    def get_exports_by_country(self, years=None):
        monthly = self._table("monthly_exports_by_country")
        return marts.by_country_from_mart(reports.filter_in(monthly, "YEAR", years))

    def get_local_data_summary(self, years=None):
        return reports.category_summary(self.exports, years)

    def get_local_value_trends(self, years=None):
        return reports.value_trends(self.exports, years)

    def get_category_performance(self, years=None):
        return reports.category_performance(self.exports, years)

    def get_monthly_patterns(self, years=None):
        return reports.monthly_patterns(self.exports, years)

    def get_economic_correlations(self, years=None, countries=None):
        return reports.economic_correlations(self.panel, self.exports, years, countries)

    def get_economic_indicators(self, years=None, countries=None):
        return reports.economic_indicators(self.panel, years, countries)

    def get_data_quality_metrics(self):
        return reports.completeness(self.panel, self.exports)

    def get_duplicates_and_age(self, run_date: date):
        return reports.duplicates_and_age(self.exports, run_date)

    def get_data_quality_checks(self):
        return self._table("export_checks").unionByName(self._table("gdp_checks"))

    def get_data_quality_issues(self):
        return quality.export_issues(current(self.spark, self.warehouse, "raw_exports"))

    def get_gdp_quality_issues(self):
        return quality.panel_issues(self.panel)

    def get_refused_files(self):
        """Landed files that were not read, each with the reasons."""
        refused = self._table("manifest").where("status = 'refused'")
        return refused.select("file", "size", "modified", "reason")

    def get_malformed_records(self):
        """Records with more or fewer fields than their header, by file."""
        return self._table("malformed_records")

    def get_load_statistics(self):
        """What each load has read and kept, counted while it was written."""
        return self._table("load_statistics").orderBy("LOAD")

    def get_data_lineage(self):
        return quality.lineage(self.exports, "exports")

    def get_active_model_info(self):
        """The registered version in use; no row before the first training."""
        try:
            registry = self._table("model_registry")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            registry = learning.empty_registry(self.spark)
        return learning.active_model(registry)

    def _active(self):
        active = self.get_active_model_info().select("model_version", "model_path").first()
        if active is None:
            raise LookupError("no model has been trained yet")
        return active

    def get_feature_importance(self, k: int = 10):
        folder = f"{self.warehouse}/models"
        table = learning.read_importances(self.spark, folder, self._active().model_version)
        return learning.top_features(table, k)

    def get_model_performance_metrics(self):
        folder = f"{self.warehouse}/models"
        metadata = learning.read_metadata(self.spark, folder, self._active().model_version)
        return learning.reported_metrics(metadata)

    def generate_predictions(self, countries=None, years=None):
        model = PipelineModel.load(self._active().model_path)
        return learning.predict(model, self._table("training_table"), countries, years)

    def validate_predictions(self, predictions: DataFrame):
        return reports.prediction_validation(predictions)

    def get_predictions(self, years=None, countries=None):
        chosen = reports.filter_in(self._table("model_predictions"), "year", years)
        return reports.filter_in(chosen, "country_code", countries)
