"""Aggregates of the clean export lines.

All are hash aggregates on their keys with partial sums before the shuffle. The
distinct counts first shuffle on key and value, so a destination with a third of
all lines is still counted by many tasks. Marts with distinct counts of region,
destination and product are rolled up from one ``pre_aggregate`` of the lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from . import rollup
from .exports import value_column
from .totals import mean, total


def monthly_by_destination(exports: DataFrame) -> DataFrame:
    """A1. A missing destination is a group of its own."""
    fob = F.col("FOB_CLEAN")
    return (
        exports.groupBy("YEAR", "MES", "PAIS_DESTINO_CLEAN")
        .agg(
            F.count("*").alias("EXPORT_COUNT"),
            total(fob).alias("TOTAL_FOB_USD"),
            mean(fob).alias("AVG_FOB_USD"),
            total(F.coalesce(F.col("PESO_BRUTO_CLEAN"), F.lit(0.0)), 3).alias("TOTAL_WEIGHT_KG"),
            F.countDistinct(C.named("RUT PROBABLE EXPORTADOR")).alias("UNIQUE_EXPORTERS"),
        )
        .filter(F.col("TOTAL_FOB_USD") > 0)
    )


#: The finest key of the marts that are rolled up, as far as a table has the columns.
FINEST = ("YEAR", "REGION_ORIGEN_CLEAN", "PAIS_DESTINO_CLEAN", "PRODUCTO_CLEAN")


def pre_aggregate(exports: DataFrame) -> DataFrame:
    """The lines by the finest key, written once for all marts that need it."""
    keys = [F.col(name) for name in FINEST if name in exports.columns]
    amounts = {"fob": (value_column(exports), 2)}
    if "FOB_PER_KG" in exports.columns:
        amounts["per_kg"] = (F.col("FOB_PER_KG"), 8)
    return rollup.pre_aggregate(exports, keys, **amounts)


def regional_by_year(exports: DataFrame, pre: DataFrame | None = None) -> DataFrame:
    """A2."""
    pre = pre or pre_aggregate(exports.drop("FOB_PER_KG"))
    sums = {"TOTAL_EXPORTS": rollup.rows(), "TOTAL_FOB_USD": rollup.total("fob"), "AVG_FOB_USD": rollup.mean("fob")}
    distinct = {"UNIQUE_DESTINATIONS": "PAIS_DESTINO_CLEAN", "UNIQUE_PRODUCTS": "PRODUCTO_CLEAN"}
    known = pre.filter(F.col("REGION_ORIGEN_CLEAN").isNotNull())
    found = rollup.rolled_up(known, ("REGION_ORIGEN_CLEAN", "YEAR"), sums, distinct)
    return found.filter(F.col("TOTAL_FOB_USD") > 0)


def product_by_year(exports: DataFrame, pre: DataFrame | None = None) -> DataFrame:
    """A3."""
    pre = pre or pre_aggregate(exports.drop("REGION_ORIGEN_CLEAN"))
    sums = {
        "EXPORT_COUNT": rollup.rows(),
        "TOTAL_FOB_USD": rollup.total("fob"),
        "AVG_FOB_USD": rollup.mean("fob"),
        "AVG_FOB_PER_KG": rollup.mean("per_kg"),
    }
    known = pre.filter(F.col("PRODUCTO_CLEAN").isNotNull())
    found = rollup.rolled_up(known, ("PRODUCTO_CLEAN", "YEAR"), sums, {"DESTINATION_DIVERSITY": "PAIS_DESTINO_CLEAN"})
    return found.filter(F.col("TOTAL_FOB_USD") > 0)


def yearly_features(exports: DataFrame, pre: DataFrame | None = None) -> DataFrame:
    """A4: one row per year for the training table."""
    pre = pre or pre_aggregate(exports.filter(F.col("YEAR").isNotNull() & (F.col("FOB_CLEAN") > 0)).drop("FOB_PER_KG"))
    sums = {
        "total_exports_usd": rollup.total("fob"),
        "avg_export_value": rollup.mean("fob"),
        "export_transactions": rollup.rows(),
    }
    distinct = {
        "export_destinations": "PAIS_DESTINO_CLEAN",
        "export_products": "PRODUCTO_CLEAN",
        "export_regions": "REGION_ORIGEN_CLEAN",
    }
    by_year = pre.filter(F.col("YEAR").isNotNull()).withColumn("year", F.col("YEAR").cast("int"))
    return rollup.rolled_up(by_year, ("year",), sums, distinct)


def _amounts(raw: DataFrame) -> dict:
    """Parsed once per line, for the several aggregates that use them."""
    return {
        "_fob": C.amount_or_null(raw, "US$ FOB"), "_weight": C.amount_or_null(raw, "PESO BRUTO")
    }


def yearly_averages(raw: DataFrame) -> DataFrame:
    """A5: averages over positive values, counts over all lines that have a FOB."""
    fob, weight = F.col("_fob"), F.col("_weight")
    lines = raw.filter(F.col("YEAR").isNotNull() & C.named("US$ FOB").isNotNull()).withColumns(_amounts(raw))
    distinct = {"unique_destinations": "PAIS DE DESTINO", "unique_products": "PRODUCTO", "unique_regions": "REGION DE ORIGEN"}
    pre = rollup.pre_aggregate(
        lines,
        [F.col("YEAR").cast("int").alias("year"), *[C.named(name) for name in distinct.values()]],
        fob=(F.when(fob > 0, fob), 2),
        weight=(F.when(weight > 0, weight), 3),
    )
    sums = {"avg_fob_value": rollup.mean("fob"), "avg_weight": rollup.mean("weight"), "export_records": rollup.rows()}
    return rollup.rolled_up(pre, ("year",), sums, distinct)


def export_summary(raw: DataFrame) -> DataFrame:
    """The summary view, on the raw spellings of destination and region."""
    return (
        raw.withColumns(_amounts(raw))
        .filter(F.col("_fob") > 0)
        .groupBy("YEAR", "MES", C.named("PAIS DE DESTINO"), C.named("REGION DE ORIGEN"))
        .agg(
            F.count("*").alias("export_count"),
            total(F.col("_fob")).alias("total_fob_usd"),
            mean(F.col("_fob")).alias("avg_fob_usd"),
            total(F.col("_weight"), 3).alias("total_weight_kg"),
            F.countDistinct(C.named("RUT PROBABLE EXPORTADOR")).alias("unique_exporters"),
        )
    )


def by_country_from_mart(monthly: DataFrame) -> DataFrame:
    """Sums of the monthly mart, so the lines are not read again; the highest
    first, over one row per country."""
    by_country = monthly.groupBy("PAIS_DESTINO_CLEAN").agg(
        total(F.col("TOTAL_FOB_USD")).alias("TOTAL_FOB_USD"),
        F.sum("EXPORT_COUNT").alias("EXPORT_COUNT"),
    )
    return by_country.orderBy(F.desc("TOTAL_FOB_USD"))


def by_country_from_lines(exports: DataFrame) -> DataFrame:
    """The same from the lines, for files without a monthly mart."""
    country = "PAIS_DESTINO_CLEAN" if "PAIS_DESTINO_CLEAN" in exports.columns else "PAIS DE DESTINO"
    fob = value_column(exports)
    return exports.groupBy(C.named(country)).agg(
        total(fob).alias("TOTAL_FOB_USD"), F.count(fob).alias("EXPORT_COUNT")
    )


def export_analytics(monthly: DataFrame, regional: DataFrame, product: DataFrame) -> DataFrame:
    """The three marts as one long table."""
    def facts(mart, kind, **columns):
        return mart.select(
            F.lit(kind).alias("analysis_type"),
            F.col("YEAR").alias("year"),
            *[F.col(source).alias(name) for name, source in columns.items()],
            F.col("TOTAL_FOB_USD").alias("total_fob_usd"),
            F.col("AVG_FOB_USD").alias("avg_fob_usd"),
        )

    long = facts(
        regional, "regional", region="REGION_ORIGEN_CLEAN", export_count="TOTAL_EXPORTS",
        unique_destinations="UNIQUE_DESTINATIONS",
    )
    for part in (
        facts(
            monthly, "monthly", month="MES", country="PAIS_DESTINO_CLEAN",
            export_count="EXPORT_COUNT", unique_exporters="UNIQUE_EXPORTERS",
        ),
        facts(
            product, "product", product="PRODUCTO_CLEAN", export_count="EXPORT_COUNT",
            unique_destinations="DESTINATION_DIVERSITY",
        ),
    ):
        long = long.unionByName(part, allowMissingColumns=True)
    return long.select(
        "analysis_type", "year", "month", "region", "country", "product", "total_fob_usd",
        "export_count", "avg_fob_usd", "unique_exporters", "unique_destinations",
    )


def presented(mart: DataFrame) -> DataFrame:
    """O1: the order marts are shown in; not used before a write."""
    keys = [name for name in ("YEAR", "MES") if name in mart.columns]
    return mart.orderBy(*keys, F.desc("TOTAL_FOB_USD"))
