"""Cleaning of export lines."""

from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..operators import exports as E
from .adapter import RUN_AT
from .registry import query

KEY_SQL = '"NUMERO DE ACEPTACION" AS acceptance, "ITEM" AS item'


def key():
    return C.named("NUMERO DE ACEPTACION").alias("acceptance"), F.col("ITEM").alias("item")


def lines(t, *columns, keep_all=False):
    return t.clean("NUMERO DE ACEPTACION", "ITEM", *columns, keep_all=keep_all)


# Headers as a file might spell them, for the canonical columns in the same order.
SPELLINGS = {
    "YEAR": " año ",
    "MES": "Month",
    "DIA": "day",
    "US$ FOB": "Valor FOB (USD)",
    "PESO BRUTO": "Peso Bruto Kg",
    "CANTIDAD": "cantidad",
    "PAIS DE DESTINO": "Pais Destino",
    "PRODUCTO": " producto",
    "REGION DE ORIGEN": "Region Origen",
    "RUT PROBABLE EXPORTADOR": "RUT Exportador",
}


@query(
    "p1_canonical_columns",
    """SELECT "YEAR", "MES", "DIA", "US$ FOB", "PESO BRUTO", "CANTIDAD", "PAIS DE DESTINO",
       "PRODUCTO", "REGION DE ORIGEN", "RUT PROBABLE EXPORTADOR", "US$ FOB" AS "TOTAL US$ FOB"
       FROM raw""",
)
def p1(t):
    raw = t.raw(*SPELLINGS).toDF(*SPELLINGS.values())
    return E.canonicalise(raw.withColumn("TOTAL US$ FOB", C.named(SPELLINGS["US$ FOB"])))


@query(
    "p2_fallback_names",
    'SELECT "YEAR", "US$ FOB" AS "US_FOB", "PAIS DE DESTINO" AS "PAIS_DESTINO" FROM raw',
)
def p2(t):
    return E.with_fallback_names(
        t.raw("YEAR", "US$ FOB", "PAIS DE DESTINO").withColumnRenamed("YEAR", "AÃ'O")
    )


@query("p3_fob_clean", f'SELECT {KEY_SQL}, "FOB_CLEAN" AS fob FROM parsed')
def p3(t):
    return lines(t, "US$ FOB", keep_all=True).select(*key(), F.col("FOB_CLEAN").alias("fob"))


# Spellings by item, and the number that each stands for.
SPELLED = """CASE "ITEM" % 7 WHEN 0 THEN '1e999' WHEN 1 THEN q || 'E3 USD' WHEN 2 THEN 'US$ ' || q || 'e-2'
    WHEN 3 THEN 'neto ' || q || ' pesos' WHEN 4 THEN '-' || q || 'E+1 EUR' WHEN 5 THEN 'E7' ELSE '1,' || q END"""
MEANT = """CASE "ITEM" % 7 WHEN 1 THEN CAST(q || 'e3' AS DOUBLE) WHEN 2 THEN CAST(q || 'e-2' AS DOUBLE)
    WHEN 3 THEN CAST(q AS DOUBLE) WHEN 4 THEN CAST('-' || q || 'e1' AS DOUBLE) WHEN 5 THEN 7.0::DOUBLE
    WHEN 6 THEN CAST('1' || q AS DOUBLE) END"""


@query(
    "p3_amount_spellings",
    f"""SELECT {KEY_SQL}, {SPELLED} AS spelled, {MEANT} AS amount
        FROM (SELECT *, nullif("PESO BRUTO", '') AS q FROM raw)""",
)
def p3_spellings(t):
    """Exponents before a unit, words with an E, numbers beyond all doubles."""
    raw = t.raw("NUMERO DE ACEPTACION", "ITEM", "PESO BRUTO").withColumn("q", F.expr("nullif(`PESO BRUTO`, '')"))
    spelled = F.expr(SPELLED.replace('"ITEM"', "ITEM"))
    raw = raw.withColumn("spelled", spelled)
    return raw.select(*key(), "spelled", C.amount_or_null(raw, "spelled").alias("amount"))


@query("p4_positive_fob", f'SELECT {KEY_SQL}, "FOB_CLEAN" AS fob FROM clean')
def p4(t):
    return lines(t, "US$ FOB").select(*key(), F.col("FOB_CLEAN").alias("fob"))


@query("p5_weight_clean", f'SELECT {KEY_SQL}, "PESO_BRUTO_CLEAN" AS weight FROM parsed')
def p5(t):
    return lines(t, "PESO BRUTO").select(*key(), F.col("PESO_BRUTO_CLEAN").alias("weight"))


@query("p6_quantity_clean", f'SELECT {KEY_SQL}, "CANTIDAD_CLEAN" AS quantity FROM parsed')
def p6(t):
    return lines(t, "CANTIDAD").select(*key(), F.col("CANTIDAD_CLEAN").alias("quantity"))


@query(
    "p7_coerced_numbers",
    f"""SELECT {KEY_SQL}, try_cast("PESO BRUTO" AS DOUBLE) AS weight,
        try_cast("US$ FOB" AS DOUBLE) AS fob FROM raw""",
)
def p7(t):
    raw = t.raw("NUMERO DE ACEPTACION", "ITEM", "PESO BRUTO", "US$ FOB")
    return E.coerce_numbers(raw, "PESO BRUTO", "US$ FOB").select(
        *key(), C.named("PESO BRUTO").alias("weight"), C.named("US$ FOB").alias("fob")
    )


@query(
    "p8_export_date",
    f'SELECT {KEY_SQL}, CAST("EXPORT_DATE" AS VARCHAR) AS export_date FROM parsed',
)
def p8(t):
    return lines(t, "YEAR", "MES", "DIA").select(
        *key(), F.col("EXPORT_DATE").cast("string").alias("export_date")
    )


@query(
    "p9_export_month",
    f"""SELECT {KEY_SQL}, CAST(make_date("YEAR", "MES", 1) AS VARCHAR) AS export_date FROM raw""",
)
def p9(t):
    return lines(t, "YEAR", "MES").select(
        *key(), F.col("EXPORT_DATE").cast("string").alias("export_date")
    )


@query("p10_destination", f'SELECT {KEY_SQL}, "PAIS_DESTINO_CLEAN" AS destination FROM parsed')
def p10(t):
    return lines(t, "PAIS DE DESTINO").select(
        *key(), F.col("PAIS_DESTINO_CLEAN").alias("destination")
    )


@query("p11_product", f'SELECT {KEY_SQL}, "PRODUCTO_CLEAN" AS product FROM parsed')
def p11(t):
    return lines(t, "PRODUCTO").select(*key(), F.col("PRODUCTO_CLEAN").alias("product"))


@query("p12_region", f'SELECT {KEY_SQL}, "REGION_ORIGEN_CLEAN" AS region FROM parsed')
def p12(t):
    return lines(t, "REGION DE ORIGEN").select(*key(), F.col("REGION_ORIGEN_CLEAN").alias("region"))


@query("p13_fob_per_kg", f'SELECT {KEY_SQL}, "FOB_PER_KG" AS fob_per_kg FROM all_lines')
def p13(t):
    df = lines(t, "US$ FOB", "PESO BRUTO", keep_all=True)
    return df.select(*key(), F.col("FOB_PER_KG").alias("fob_per_kg"))


@query("p14_fob_per_unit", f'SELECT {KEY_SQL}, "FOB_PER_UNIT" AS fob_per_unit FROM all_lines')
def p14(t):
    df = lines(t, "US$ FOB", "CANTIDAD", keep_all=True)
    return df.select(*key(), F.col("FOB_PER_UNIT").alias("fob_per_unit"))


@query("p15_size_band", f'SELECT {KEY_SQL}, "EXPORT_SIZE_CATEGORY" AS size FROM clean')
def p15(t):
    return lines(t, "US$ FOB").select(*key(), F.col("EXPORT_SIZE_CATEGORY").alias("size"))


@query("p16_region_group", f'SELECT {KEY_SQL}, "REGION_GROUP" AS region_group FROM all_lines')
def p16(t):
    return lines(t, "REGION DE ORIGEN").select(*key(), F.col("REGION_GROUP").alias("region_group"))


@query(
    "p17_audit_columns",
    f"""SELECT {KEY_SQL}, '2025-01-15 06:00:00' AS processed_at,
        '2025-01-15' AS processing_date, 'SPARK' AS processing_method FROM clean""",
)
def p17(t):
    df = E.with_audit(lines(t, "US$ FOB"), RUN_AT)
    return df.select(
        *key(),
        F.date_format("PROCESSED_AT", "yyyy-MM-dd HH:mm:ss").alias("processed_at"),
        F.col("PROCESSING_DATE").cast("string").alias("processing_date"),
        F.col("PROCESSING_METHOD").alias("processing_method"),
    )


@query(
    "p18_year_filter",
    f'SELECT {KEY_SQL}, "YEAR" AS year FROM raw WHERE "YEAR" IN (2020, 2022)',
)
def p18(t):
    raw = t.raw("NUMERO DE ACEPTACION", "ITEM", "YEAR")
    return E.filter_in(raw, "YEAR", [2020, 2022]).select(*key(), F.col("YEAR").alias("year"))


@query("p18_year_filter_empty", f'SELECT {KEY_SQL}, "YEAR" AS year FROM raw')
def p18_empty(t):
    raw = t.raw("NUMERO DE ACEPTACION", "ITEM", "YEAR")
    return E.filter_in(raw, "YEAR", []).select(*key(), F.col("YEAR").alias("year"))


@query(
    "p19_country_filter",
    f"""SELECT {KEY_SQL}, "PAIS_DESTINO_CLEAN" AS destination FROM parsed
        WHERE "PAIS_DESTINO_CLEAN" IN ('NATION A', 'NATION K')""",
)
def p19(t):
    df = E.filter_in(lines(t, "PAIS DE DESTINO"), "PAIS_DESTINO_CLEAN", ["NATION A", "NATION K"])
    return df.select(*key(), F.col("PAIS_DESTINO_CLEAN").alias("destination"))


@query(
    "p20_value_column",
    f"""SELECT {KEY_SQL}, "FOB_CLEAN" AS clean_value,
        try_cast(regexp_replace("US$ FOB", '[^0-9.\\-]', '', 'g') AS DOUBLE) AS raw_value
        FROM all_lines""",
)
def p20(t):
    df = lines(t, "US$ FOB", keep_all=True)
    return df.select(
        *key(),
        E.value_column(df).alias("clean_value"),
        E.value_column(df.drop("FOB_CLEAN")).alias("raw_value"),
    )


@query("p21_existing_columns", 'SELECT "YEAR", "PRODUCTO" FROM raw')
def p21(t):
    return E.keep_columns(t.raw("MES", "YEAR", "PRODUCTO"), "YEAR", "VARIEDAD", "PRODUCTO")


@query(
    "p_clean_exports",
    f"""SELECT {KEY_SQL}, "YEAR", "MES", "FOB_CLEAN", "PESO_BRUTO_CLEAN", "CANTIDAD_CLEAN",
        CAST("EXPORT_DATE" AS VARCHAR) AS "EXPORT_DATE", "PAIS_DESTINO_CLEAN", "PRODUCTO_CLEAN",
        "REGION_ORIGEN_CLEAN", "FOB_PER_KG", "FOB_PER_UNIT", "EXPORT_SIZE_CATEGORY",
        "REGION_GROUP" FROM clean""",
)
def p_all(t):
    return t.clean().select(
        *key(), "YEAR", "MES", "FOB_CLEAN", "PESO_BRUTO_CLEAN", "CANTIDAD_CLEAN",
        F.col("EXPORT_DATE").cast("string").alias("EXPORT_DATE"), "PAIS_DESTINO_CLEAN",
        "PRODUCTO_CLEAN", "REGION_ORIGEN_CLEAN", "FOB_PER_KG", "FOB_PER_UNIT",
        "EXPORT_SIZE_CATEGORY", "REGION_GROUP",
    )
