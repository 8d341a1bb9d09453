"""Data-quality checks: one row per check, all of a table's checks in one pass."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..schemas import EXPORT_COLUMNS

# Name, comparison and threshold of every check.
CHECKS = {
    "DQ1": ("records loaded today", ">=", 1.0),
    "DQ2": ("invalid FOB percent", "<=", 10.0),
    "DQ3": ("distinct destinations", ">=", 5.0),
    "DQ4": ("recent rows", ">=", 100.0),
    "DQ5": ("invalid GDP rows", "<=", 0.0),
    "DQ6": ("invalid ranking rows", "<=", 0.0),
    "DQ7": ("top economies in the newest year", ">=", 10.0),
    "DQ8": ("duplicate country-years", "<=", 0.0),
    "DQ9": ("values beyond declared limits", "<=", 0.0),
    "DQ10": ("orphan predictions", "<=", 0.0),
}
RECENT_YEAR = 2022
TOP_RANK = 10


def as_checks(one_row: DataFrame, *ids: str) -> DataFrame:
    """Turn one row of measures, named by check, into one row per check."""
    rows = F.array(
        *[
            F.struct(
                F.lit(check).alias("check_id"),
                F.lit(CHECKS[check][0]).alias("check_name"),
                F.col(check).cast("double").alias("value"),
                F.lit(CHECKS[check][2]).alias("threshold"),
                F.lit(CHECKS[check][1]).alias("operator"),
            )
            for check in ids
        ]
    )
    checks = one_row.select(F.inline(rows))
    passed = F.when(F.col("operator") == ">=", F.col("value") >= F.col("threshold")).otherwise(
        F.col("value") <= F.col("threshold")
    )
    # A check without a value, as on an empty table, has not passed.
    return checks.withColumn("passed", F.coalesce(passed, F.lit(False)))


def invalid_fob(df: DataFrame) -> Column:
    """Missing, unreadable or negative."""
    fob = C.amount_or_null(df, "US$ FOB")
    return fob.isNull() | (fob < 0)


def known_destination() -> Column:
    name = C.named("PAIS DE DESTINO")
    return F.when(F.trim(name) != "", name)


def beyond_limit(df: DataFrame, name: str) -> Column:
    """DQ9: a value that its declared column could not hold."""
    declared = EXPORT_COLUMNS[name]
    if declared.startswith("varchar"):
        return F.length(C.named(name).cast("string")) > int(re.findall(r"\d+", declared)[0])
    value = C.amount_or_null(df, name)
    if declared == "int":
        return F.abs(value) >= 2.0**31
    digits, scale = (int(n) for n in re.findall(r"\d+", declared))
    return F.abs(value) >= 10.0 ** (digits - scale)


def limited_columns(raw: DataFrame) -> list[str]:
    return [n for n in raw.columns if EXPORT_COLUMNS.get(n, "text") != "text"]


def limit_violations(raw: DataFrame) -> DataFrame:
    """DQ9 by column: how many values are beyond the declared limit."""
    limited = limited_columns(raw)
    counts = raw.agg(*[F.count(F.when(beyond_limit(raw, n), 1)).alias(n) for n in limited])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("column"), C.named(n).alias("violations")) for n in limited]
    )
    return counts.select(F.inline(pairs))


def export_measures(raw: DataFrame) -> dict[str, Column]:
    """Counts behind DQ1, DQ2 and DQ9, which can also be observed while rows are written."""
    # A null field is within its limits.
    within = [F.coalesce(beyond_limit(raw, n).cast("int"), F.lit(0)) for n in limited_columns(raw)]
    return {
        "records": F.count(F.lit(1)),
        "invalid_fob": F.count(F.when(invalid_fob(raw), 1)),
        "beyond_limits": F.coalesce(F.sum(sum(within, F.lit(0))), F.lit(0)),
    }


def as_export_checks(counts: DataFrame) -> DataFrame:
    """DQ1-DQ3 and DQ9 from one row of ``export_measures`` and ``destinations``."""
    measures = counts.select(
        F.col("records").alias("DQ1"),
        F.try_divide(F.col("invalid_fob") * 100.0, F.col("records")).alias("DQ2"),
        F.col("destinations").alias("DQ3"),
        F.col("beyond_limits").alias("DQ9"),
    )
    return as_checks(measures, "DQ1", "DQ2", "DQ3", "DQ9")


def export_checks(raw: DataFrame, run_date: date | None = None) -> DataFrame:
    """DQ1-DQ3 and DQ9 over the raw lines, or those loaded since the run date."""
    measures = export_measures(raw)
    if run_date is not None:
        raw = raw.filter(F.col("EXTRACTION_DATE") >= F.lit(run_date))
    counts = [value.alias(name) for name, value in measures.items()]
    return as_export_checks(raw.agg(*counts, F.countDistinct(known_destination()).alias("destinations")))


def panel_checks(panel: DataFrame) -> DataFrame:
    """DQ4-DQ8 in one job: per country-year, then per year, then over all. The
    newest year's count is picked by ``max_by``, without a second read."""
    gdp, ranking = F.col("gdp_value"), F.col("ranking")
    per_key = panel.groupBy("country_code", "year").agg(
        F.count("*").alias("rows"),
        F.count(F.when(gdp.isNull() | (gdp <= 0), 1)).alias("bad_gdp"),
        F.count(F.when(ranking.isNull() | (ranking <= 0), 1)).alias("bad_ranking"),
        F.count(F.when(ranking <= TOP_RANK, 1)).alias("top"),
    )
    per_year = per_key.groupBy("year").agg(
        F.sum("rows").alias("rows"),
        F.sum("bad_gdp").alias("bad_gdp"),
        F.sum("bad_ranking").alias("bad_ranking"),
        F.sum("top").alias("top"),
        F.count(F.when(F.col("rows") > 1, 1)).alias("repeated"),
    )
    none = F.lit(0)
    measures = per_year.agg(
        F.coalesce(F.sum(F.when(F.col("year") >= RECENT_YEAR, F.col("rows"))), none).alias("DQ4"),
        F.coalesce(F.sum("bad_gdp"), none).alias("DQ5"),
        F.coalesce(F.sum("bad_ranking"), none).alias("DQ6"),
        F.coalesce(F.max_by("top", "year"), none).alias("DQ7"),
        F.coalesce(F.sum("repeated"), none).alias("DQ8"),
    )
    return as_checks(measures, "DQ4", "DQ5", "DQ6", "DQ7", "DQ8")


def orphan_predictions(predictions: DataFrame, registry: DataFrame) -> DataFrame:
    """Predictions of models that are not registered."""
    return predictions.join(registry, "model_version", "left_anti")


def prediction_checks(predictions: DataFrame, registry: DataFrame) -> DataFrame:
    """DQ10."""
    orphans = orphan_predictions(predictions, registry).agg(F.count("*").alias("DQ10"))
    return as_checks(orphans, "DQ10")


def failed_rollup(checks: DataFrame) -> DataFrame:
    """DQ11."""
    return checks.agg(
        F.count("*").alias("checks"),
        F.coalesce(F.sum((~F.col("passed")).cast("int")), F.lit(0)).alias("failed"),
    )


def status_lines(checks: DataFrame) -> DataFrame:
    """The checks as text."""
    verdict = F.when(F.col("passed"), "PASS").otherwise("FAIL")
    return checks.select(
        "check_id",
        F.format_string(
            "%s: %s (got %s, expected %s %s)", "check_name", verdict, F.col("value"), "operator",
            F.col("threshold"),
        ).alias("status"),
    )


def export_issues(raw: DataFrame) -> DataFrame:
    """The raw lines that fail DQ2, DQ3 or DQ9, each with the checks it fails."""
    limited = limited_columns(raw)
    over = F.lit(False)
    for name in limited:
        over = over | F.coalesce(beyond_limit(raw, name), F.lit(False))
    failures = F.array_compact(
        F.array(
            F.when(invalid_fob(raw), "DQ2"),
            F.when(known_destination().isNull(), "DQ3"),
            F.when(over, "DQ9"),
        )
    )
    return raw.withColumn("failed_checks", failures).filter(F.size("failed_checks") > 0)


def panel_issues(panel: DataFrame) -> DataFrame:
    """The panel rows that fail DQ5, DQ6 or DQ8, each with the checks it fails."""
    repeated = (
        panel.groupBy("country_code", "year").agg(F.count("*").alias("_rows")).filter("_rows > 1")
    )
    gdp, ranking = F.col("gdp_value"), F.col("ranking")
    marked = panel.join(repeated, ["country_code", "year"], "left")
    failures = F.array_compact(
        F.array(
            F.when(gdp.isNull() | (gdp <= 0), "DQ5"),
            F.when(ranking.isNull() | (ranking <= 0), "DQ6"),
            F.when(F.col("_rows") > 1, "DQ8"),
        )
    )
    return marked.withColumn("failed_checks", failures).filter(F.size("failed_checks") > 0).drop("_rows")


def lineage(exports: DataFrame, dataset: str) -> DataFrame:
    """Which files a dataset came from, and when each was last read."""
    return exports.groupBy(F.col("SOURCE_FILE").alias("source")).agg(
        F.lit(dataset).alias("dataset"),
        F.max("EXTRACTION_DATE").alias("last_extraction"),
        F.count("*").alias("records"),
    )
