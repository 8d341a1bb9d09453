"""Named subqueries for the check SQL, in the dialect of the checking engine."""

from __future__ import annotations

import re

from ..constants import (
    ECONOMY_SIZES,
    EXCLUDED_CODES,
    REGION_GROUPS,
    SIZE_BANDS,
    SMALLEST_ECONOMY,
    SMALLEST_SIZE,
    WORLD_REGIONS,
)
from ..functions.cleaning import ACCENTED, PLAIN
from .adapter import COUNTRY_CODES, INDICATOR, REGION_NAMES


def text(value: str | None) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'"


def texts(values) -> str:
    return ", ".join(text(v) for v in values)


def total(column: str, scale: int = 2) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(28,{scale}))) AS DOUBLE)"


def mean(column: str, scale: int = 2) -> str:
    return f"({total(column, scale)} / count({column}))"


def bands(column: str, steps, smallest: str) -> str:
    cases = " ".join(f"WHEN {column} >= {bound} THEN {text(name)}" for bound, name in steps)
    return f"CASE {cases} ELSE {text(smallest)} END"


def number(column: str) -> str:
    return f"try_cast(regexp_replace({column}, '[^0-9.\\-]', '', 'g') AS DOUBLE)"


def fold(column: str) -> str:
    return f"translate({column}, '{ACCENTED}', '{PLAIN}')"


_group = " ".join(
    f"WHEN contains(region_key, {text(word)}) THEN {text(name)}" for word, name in REGION_GROUPS
)
_world = " ".join(
    f"WHEN country_code IN ({texts(codes)}) THEN {text(name)}"
    for name, codes in WORLD_REGIONS.items()
)
_by_country = "OVER (PARTITION BY country_code ORDER BY year)"
BY_COUNTRY = _by_country
LAST_THREE = "OVER (PARTITION BY country_code ORDER BY year ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"

CTES = {
    "raw": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS "NUMERO DE ACEPTACION",
               l_linenumber AS "ITEM",
               CAST(year(o_orderdate) + 23 AS INT) AS "YEAR",
               CAST(month(o_orderdate) AS INT) AS "MES",
               CAST(CASE WHEN l_linenumber = 7 THEN 31 ELSE day(o_orderdate) END AS INT) AS "DIA",
               CASE WHEN l_orderkey % 97 <> 0 THEN 'US$ ' || CAST(CAST(
                 CASE WHEN l_orderkey % 89 = 0 THEN -1 ELSE 1 END
                 * CAST(l_extendedprice AS DECIMAL(18,2))
                 * CASE l_linenumber % 3 WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE 100 END
                 AS DECIMAL(18,2)) AS VARCHAR) END AS "US$ FOB",
               CASE WHEN l_orderkey % 83 = 0 THEN '' ELSE CAST(l_quantity AS VARCHAR) END
                 AS "PESO BRUTO",
               CAST(l_linenumber AS VARCHAR) AS "CANTIDAD",
               ' nation ' || chr(CAST(65 + c_nationkey AS INT)) AS "PAIS DE DESTINO",
               p_name || ' ' AS "PRODUCTO",
               list_extract([{texts(REGION_NAMES)}], CAST(s_nationkey % 17 + 1 AS INT))
                 AS "REGION DE ORIGEN",
               CASE WHEN o_custkey % 71 <> 0 THEN CAST(o_custkey AS VARCHAR) END
                 AS "RUT PROBABLE EXPORTADOR",
               'exports_' || CAST(year(o_orderdate) + 23 AS VARCHAR) AS "SOURCE_FILE",
               c_nationkey
        FROM lineitem
        LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN part ON l_partkey = p_partkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "parsed": f"""
        SELECT *,
               coalesce({number('"US$ FOB"')}, 0) AS "FOB_CLEAN",
               coalesce({number('"PESO BRUTO"')}, 0) AS "PESO_BRUTO_CLEAN",
               coalesce({number('"CANTIDAD"')}, 0) AS "CANTIDAD_CLEAN",
               CASE WHEN "MES" BETWEEN 1 AND 12 AND "DIA" BETWEEN 1 AND 31 THEN
                 try_cast(printf('%d-%02d-%02d', "YEAR", "MES", "DIA") AS DATE) END AS "EXPORT_DATE",
               trim(upper(regexp_replace({fold('"PAIS DE DESTINO"')}, '[^A-Za-z\\s]', '', 'g')))
                 AS "PAIS_DESTINO_CLEAN",
               trim(upper("PRODUCTO")) AS "PRODUCTO_CLEAN",
               trim(upper("REGION DE ORIGEN")) AS "REGION_ORIGEN_CLEAN",
               replace({fold('upper("REGION DE ORIGEN")')}, chr(39), '') AS region_key
        FROM raw""",
    "all_lines": f"""
        SELECT *,
               CASE WHEN "FOB_CLEAN" > 0 AND "PESO_BRUTO_CLEAN" > 0
                 THEN "FOB_CLEAN" / "PESO_BRUTO_CLEAN" END AS "FOB_PER_KG",
               CASE WHEN "FOB_CLEAN" > 0 AND "CANTIDAD_CLEAN" > 0
                 THEN "FOB_CLEAN" / "CANTIDAD_CLEAN" END AS "FOB_PER_UNIT",
               {bands('"FOB_CLEAN"', SIZE_BANDS, SMALLEST_SIZE)} AS "EXPORT_SIZE_CATEGORY",
               CASE {_group} ELSE 'Other' END AS "REGION_GROUP"
        FROM parsed""",
    "clean": 'SELECT * FROM all_lines WHERE "FOB_CLEAN" > 0',
    "gdp": f"""
        SELECT list_extract([{texts(COUNTRY_CODES)}], CAST(c_nationkey + 1 AS INT)) AS country_code,
               n_name AS country_name, {text(INDICATOR[0])} AS indicator_code,
               {text(INDICATOR[1])} AS indicator_name, "YEAR" AS year,
               {total('"FOB_CLEAN"')}
                 * CASE c_nationkey % 4 WHEN 0 THEN 10 WHEN 1 THEN 100 WHEN 2 THEN 1000 ELSE 10000 END
                 AS gdp_value
        FROM clean LEFT JOIN nation ON c_nationkey = n_nationkey
        GROUP BY c_nationkey, n_name, "YEAR" """,
    "classified": f"""
        SELECT *, gdp_value / 1e9 AS gdp_billion_usd, ln(gdp_value) AS log_gdp,
               log10(gdp_value) AS log10_gdp, CASE {_world} ELSE 'Other' END AS region,
               {bands('gdp_value', ECONOMY_SIZES, SMALLEST_ECONOMY)} AS economy_size
        FROM gdp
        WHERE gdp_value > 0 AND country_code IS NOT NULL
          AND country_code NOT IN ({texts(EXCLUDED_CODES)})""",
    "panel": f"""
        SELECT *,
               CAST(dense_rank() OVER (PARTITION BY year ORDER BY gdp_value DESC) AS INT) AS ranking,
               (gdp_value / lag(gdp_value) {_by_country} - 1) * 100 AS gdp_growth_rate
        FROM classified""",
    "records": """
        SELECT CASE WHEN country_code = 'HIC' THEN '' ELSE country_code END AS countryiso3code,
               CAST(year AS VARCHAR) AS date,
               CASE WHEN country_code = 'EUU' AND year = 2018 THEN NULL
                 ELSE CAST(CAST(gdp_value AS DECIMAL(28,2)) AS VARCHAR) END AS value,
               country_code AS country_id, country_name, indicator_code, indicator_name
        FROM gdp""",
    "valid_records": """
        SELECT * FROM records
        WHERE value <> '' AND country_name <> '' AND countryiso3code <> ''""",
    "flat_records": """
        SELECT countryiso3code AS country_code, country_name, indicator_code, indicator_name,
               CAST(date AS INT) AS year, CAST(value AS DOUBLE) AS gdp_value
        FROM valid_records""",
    "monthly": f"""
        SELECT "YEAR", "MES", "PAIS_DESTINO_CLEAN", count(*) AS "EXPORT_COUNT",
               {total('"FOB_CLEAN"')} AS "TOTAL_FOB_USD", {mean('"FOB_CLEAN"')} AS "AVG_FOB_USD",
               {total('"PESO_BRUTO_CLEAN"', 3)} AS "TOTAL_WEIGHT_KG",
               count(DISTINCT "RUT PROBABLE EXPORTADOR") AS "UNIQUE_EXPORTERS"
        FROM clean GROUP BY "YEAR", "MES", "PAIS_DESTINO_CLEAN"
        HAVING sum("FOB_CLEAN") > 0""",
    "regional": f"""
        SELECT "REGION_ORIGEN_CLEAN", "YEAR", count(*) AS "TOTAL_EXPORTS",
               {total('"FOB_CLEAN"')} AS "TOTAL_FOB_USD", {mean('"FOB_CLEAN"')} AS "AVG_FOB_USD",
               count(DISTINCT "PAIS_DESTINO_CLEAN") AS "UNIQUE_DESTINATIONS",
               count(DISTINCT "PRODUCTO_CLEAN") AS "UNIQUE_PRODUCTS"
        FROM clean WHERE "REGION_ORIGEN_CLEAN" IS NOT NULL
        GROUP BY "REGION_ORIGEN_CLEAN", "YEAR" HAVING sum("FOB_CLEAN") > 0""",
    "product": f"""
        SELECT "PRODUCTO_CLEAN", "YEAR", count(*) AS "EXPORT_COUNT",
               {total('"FOB_CLEAN"')} AS "TOTAL_FOB_USD", {mean('"FOB_CLEAN"')} AS "AVG_FOB_USD",
               {mean('"FOB_PER_KG"', 8)} AS "AVG_FOB_PER_KG",
               count(DISTINCT "PAIS_DESTINO_CLEAN") AS "DESTINATION_DIVERSITY"
        FROM clean WHERE "PRODUCTO_CLEAN" IS NOT NULL
        GROUP BY "PRODUCTO_CLEAN", "YEAR" HAVING sum("FOB_CLEAN") > 0""",
    "yearly": f"""
        SELECT "YEAR" AS year, {total('"FOB_CLEAN"')} AS total_exports_usd,
               {mean('"FOB_CLEAN"')} AS avg_export_value, count(*) AS export_transactions,
               count(DISTINCT "PAIS_DESTINO_CLEAN") AS export_destinations,
               count(DISTINCT "PRODUCTO_CLEAN") AS export_products,
               count(DISTINCT "REGION_ORIGEN_CLEAN") AS export_regions
        FROM clean WHERE "YEAR" IS NOT NULL GROUP BY "YEAR" """,
    "averages": f"""
        SELECT "YEAR" AS year,
               {mean('CASE WHEN fob > 0 THEN fob END')} AS avg_fob_value,
               {mean('CASE WHEN weight > 0 THEN weight END', 3)} AS avg_weight,
               count(*) AS export_records,
               count(DISTINCT "PAIS DE DESTINO") AS unique_destinations,
               count(DISTINCT "PRODUCTO") AS unique_products,
               count(DISTINCT "REGION DE ORIGEN") AS unique_regions
        FROM (SELECT *, {number('"US$ FOB"')} AS fob, {number('"PESO BRUTO"')} AS weight
              FROM raw WHERE "YEAR" IS NOT NULL AND "US$ FOB" IS NOT NULL)
        GROUP BY "YEAR" """,
    "export_analytics": """
        SELECT 'regional' AS analysis_type, "YEAR" AS year, CAST(NULL AS INT) AS month,
               "REGION_ORIGEN_CLEAN" AS region, CAST(NULL AS VARCHAR) AS country,
               CAST(NULL AS VARCHAR) AS product, "TOTAL_FOB_USD" AS total_fob_usd,
               "TOTAL_EXPORTS" AS export_count, "AVG_FOB_USD" AS avg_fob_usd,
               CAST(NULL AS BIGINT) AS unique_exporters,
               "UNIQUE_DESTINATIONS" AS unique_destinations FROM regional
        UNION ALL
        SELECT 'monthly', "YEAR", "MES", NULL, "PAIS_DESTINO_CLEAN", NULL, "TOTAL_FOB_USD",
               "EXPORT_COUNT", "AVG_FOB_USD", "UNIQUE_EXPORTERS", NULL FROM monthly
        UNION ALL
        SELECT 'product', "YEAR", NULL, NULL, NULL, "PRODUCTO_CLEAN", "TOTAL_FOB_USD",
               "EXPORT_COUNT", "AVG_FOB_USD", NULL, "DESTINATION_DIVERSITY" FROM product""",
    "ml_rows": """
        SELECT country_code, country_name, year, gdp_value, ranking, gdp_growth_rate,
               gdp_billion_usd, log_gdp
        FROM panel WHERE gdp_value > 0 AND year BETWEEN 2019 AND 2024""",
    "joined_yearly": """
        SELECT m.*, coalesce(total_exports_usd, 0) AS total_exports_usd,
               coalesce(avg_export_value, 0) AS avg_export_value,
               coalesce(export_transactions, 0) AS export_transactions,
               coalesce(export_destinations, 0) AS export_destinations,
               coalesce(export_products, 0) AS export_products,
               coalesce(export_regions, 0) AS export_regions
        FROM (SELECT * FROM ml_rows WHERE gdp_billion_usd >= 10) m LEFT JOIN yearly USING (year)""",
    "joined_averages": """
        SELECT country_code, country_name, year, gdp_value, ranking,
               coalesce(gdp_growth_rate, 0) AS gdp_growth_rate, region, economy_size,
               coalesce(avg_fob_value, 0) AS local_avg_fob,
               coalesce(avg_weight, 0) AS local_avg_weight,
               coalesce(export_records, 0) AS local_export_records,
               coalesce(unique_destinations, 0) AS local_unique_destinations,
               coalesce(unique_products, 0) AS local_unique_products,
               coalesce(unique_regions, 0) AS local_unique_regions,
               log10(gdp_value) AS log10_gdp, gdp_value / 1e9 AS gdp_billion_usd
        FROM panel LEFT JOIN averages USING (year) WHERE gdp_value > 0""",
}


def with_ctes(body: str) -> str:
    """The statement with the subqueries it refers to, and theirs, in front."""
    wanted: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"(?:FROM|JOIN)\s+\(?(\w+)", sql):
            if name in CTES and name not in wanted:
                visit(CTES[name])
                wanted.append(name)

    visit(body)
    if not wanted:
        return body.strip()
    parts = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in wanted)
    return f"WITH {parts}\n{body.strip()}"
