"""The GDP job: landed pages to the stored panel and its checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ENOUGH_RECORDS_PER_YEAR
from ..operators import panel, quality
from ..sources.gdp_files import read_newest_gdp, read_until_enough
from ..sources.tables import read_table, replace_partitions, write_table


def run(
    spark: SparkSession, landing: str, warehouse: str, run_at: datetime, enough: int | None = ENOUGH_RECORDS_PER_YEAR
) -> DataFrame:
    """The incoming years replace those stored, of a record fetched twice the newest; ranks and growth are then computed
    over all stored years. Returns the checks.

    Years come in newest first, until one has more than ``enough`` records; None takes all.
    """
    found = read_newest_gdp(spark, landing) if enough is None else read_until_enough(spark, landing, enough)
    records = found.withColumn("extraction_date", F.lit(run_at))
    stored = replace_partitions(records, f"{warehouse}/gdp_records")
    built = panel.with_audit(panel.build_panel(read_table(spark, stored)), run_at)
    write_table(built, f"{warehouse}/gdp_panel", by="year")
    checks = quality.panel_checks(read_table(spark, f"{warehouse}/gdp_panel"))
    write_table(checks, f"{warehouse}/gdp_checks")
    return read_table(spark, f"{warehouse}/gdp_checks")
