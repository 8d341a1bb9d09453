"""DQ1-DQ11: data-quality checks."""

from datetime import date, datetime

from pyspark.sql import functions as F

from ..operators import quality as Q
from .aggregates import MODELS, predictions_and_registry
from .ctes import number
from .registry import query

# All limited columns that the adapted lines have.
LIMITED = ("US$ FOB", "PESO BRUTO", "PAIS DE DESTINO", "REGION DE ORIGEN", "YEAR", "MES", "DIA", "ITEM", "CANTIDAD",
           "NUMERO DE ACEPTACION", "RUT PROBABLE EXPORTADOR")
OVER = [
    *[f"abs({number(name)}) >= {most}" for name, most in (('"US$ FOB"', "1e13"), ('"PESO BRUTO"', "1e12"), ('"CANTIDAD"', "1e12"))],
    *[f"length({name}) > {most}" for name, most in (
        ('"PAIS DE DESTINO"', 100), ('"REGION DE ORIGEN"', 100), ('"NUMERO DE ACEPTACION"', 50), ('"RUT PROBABLE EXPORTADOR"', 20))],
    *[f'abs("{name}") >= 2147483648' for name in ("YEAR", "MES", "DIA", "ITEM")],
]
BEYOND = " + ".join(f"CAST(coalesce({one}, FALSE) AS INT)" for one in OVER)


def check(check_id, value, source):
    name, operator, threshold = Q.CHECKS[check_id]
    return f"""SELECT '{check_id}' AS check_id, '{name}' AS check_name, value,
        {threshold}::DOUBLE AS threshold, '{operator}' AS operator,
        value {operator} {threshold} AS passed
        FROM (SELECT CAST({value} AS DOUBLE) AS value FROM {source}) """


DQ1 = check("DQ1", "count(*)", "raw")
DQ2 = check(
    "DQ2",
    f"""count(*) FILTER ({number('"US$ FOB"')} IS NULL OR {number('"US$ FOB"')} < 0)
        * 100.0::DOUBLE / count(*)""",
    "raw",
)
DQ3 = check(
    "DQ3",
    """count(DISTINCT CASE WHEN trim("PAIS DE DESTINO") <> '' THEN "PAIS DE DESTINO" END)""",
    "raw",
)
DQ4 = check("DQ4", "count(*) FILTER (year >= 2022)", "panel")
DQ5 = check("DQ5", "count(*) FILTER (gdp_value IS NULL OR gdp_value <= 0)", "panel")
DQ6 = check("DQ6", "count(*) FILTER (ranking IS NULL OR ranking <= 0)", "panel")
DQ7 = check(
    "DQ7", "count(*) FILTER (ranking <= 10 AND year = (SELECT max(year) FROM panel))", "panel"
)
DQ8 = check(
    "DQ8",
    "count(*)",
    "(SELECT 1 FROM panel GROUP BY country_code, year HAVING count(*) > 1)",
)
DQ9 = check("DQ9", f"sum({BEYOND})", "raw")
DQ10 = check("DQ10", f"count(*) FILTER ('v' || year NOT IN ({MODELS}))", "panel")

EXPORT_CHECKS = {"dq1_records_loaded": DQ1, "dq2_invalid_fob": DQ2, "dq3_destinations": DQ3,
                 "dq9_declared_limits": DQ9}
PANEL_CHECKS = {"dq4_recent_rows": DQ4, "dq5_invalid_gdp": DQ5, "dq6_invalid_ranking": DQ6,
                "dq7_top_economies": DQ7, "dq8_duplicate_country_years": DQ8}


def only(check_id):
    return F.col("check_id") == check_id.split("_")[0].upper()


for _name, _sql in EXPORT_CHECKS.items():
    query(_name, _sql)(lambda t, n=_name: Q.export_checks(t.raw(*LIMITED)).filter(only(n)))
for _name, _sql in PANEL_CHECKS.items():
    query(_name, _sql)(lambda t, n=_name: Q.panel_checks(t.panel()).filter(only(n)))


@query(
    "dq1_records_loaded_since",
    """SELECT 'DQ1' AS check_id, count(*)::DOUBLE AS value, count(*) >= 1 AS passed
       FROM raw WHERE "YEAR" >= 2023""",
)
def dq1_since(t):
    """Lines count as extracted at the start of their year."""
    at = F.make_timestamp("YEAR", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    raw = t.raw("US$ FOB", "PAIS DE DESTINO", "YEAR").withColumn("EXTRACTION_DATE", at)
    checks = Q.export_checks(raw, date(2023, 1, 1))
    return checks.filter(only("dq1")).select("check_id", "value", "passed")


@query("dq10_orphan_predictions", DQ10)
def dq10(t):
    return Q.prediction_checks(*predictions_and_registry(t))


ALL_CHECKS = " UNION ALL ".join([*EXPORT_CHECKS.values(), *PANEL_CHECKS.values()])


@query("dq_all_checks", ALL_CHECKS)
def all_checks(t):
    return Q.export_checks(t.raw(*LIMITED)).unionByName(Q.panel_checks(t.panel()))


@query(
    "dq11_failed_rollup",
    f"""SELECT count(*) AS checks, CAST(count(*) FILTER (NOT passed) AS BIGINT) AS failed
        FROM ({ALL_CHECKS})""",
)
def dq11(t):
    return Q.failed_rollup(all_checks(t))


@query(
    "dq_export_issues",
    f"""SELECT "NUMERO DE ACEPTACION", "ITEM", "US$ FOB", 'DQ2' AS failed_checks FROM raw
        WHERE {number('"US$ FOB"')} IS NULL OR {number('"US$ FOB"')} < 0""",
)
def issues(t):
    found = Q.export_issues(t.raw(*LIMITED))
    return found.select(
        "NUMERO DE ACEPTACION", "ITEM", "US$ FOB",
        F.concat_ws(",", "failed_checks").alias("failed_checks"),
    )


@query(
    "dq_lineage",
    """SELECT "SOURCE_FILE" AS source, 'exports' AS dataset,
       '2025-01-15 06:00:00' AS last_extraction, count(*) AS records FROM raw GROUP BY 1""",
)
def lineage(t):
    raw = t.raw("SOURCE_FILE").withColumn(
        "EXTRACTION_DATE", F.lit(datetime(2025, 1, 15, 6, 0, 0))
    )
    return Q.lineage(raw, "exports").withColumn(
        "last_extraction", F.date_format("last_extraction", "yyyy-MM-dd HH:mm:ss")
    )
