"""Cleaning expressions on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tradepanel.functions import cleaning as C
from tradepanel.operators import exports as E


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


@pytest.mark.parametrize(
    "text, number",
    [
        ("1234.5", 1234.5),
        ("US$ 1,234.50", 1234.5),
        ("$-12.5", -12.5),
        (" 7 ", 7.0),
        ("", 0.0),
        ("abc", 0.0),
        ("1.2.3", 0.0),
        ("12-3", 0.0),
        ("US$ 1.25E7", 12_500_000.0),
        ("2,500e-2 ", 25.0),
        ("7 EUR", 7.0),
        ("1e30", 1e30),
        ("1.25E7 USD", 12_500_000.0),
        ("neto 3", 3.0),
        ("E7", 7.0),
        ("1e999", 0.0),
        ("-1E400 USD", 0.0),
        ("9" * 400, 0.0),
        ("1" + "0" * 299, 1e299),
        (None, 0.0),
    ],
)
def test_amount_of_text(spark, text, number):
    df = spark.createDataFrame([(text,)], "`US$ FOB` STRING")
    assert values(df, C.amount(df, "US$ FOB")) == [number]


def test_large_number_keeps_its_exponent(spark):
    df = spark.createDataFrame([(1.25e7,), (None,)], "`US$ FOB` DOUBLE")
    assert values(df, C.amount(df, "US$ FOB")) == [12_500_000.0, 0.0]


def test_numbers_that_are_not_finite_are_no_amounts(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (2.0,)], "`US$ FOB` DOUBLE")
    assert values(df, C.amount_or_null(df, "US$ FOB")) == [None, None, 2.0]


def test_weight_keeps_its_sign(spark):
    df = spark.createDataFrame([("-12.5",)], "`PESO BRUTO` STRING")
    assert values(df, C.amount(df, "PESO BRUTO")) == [-12.5]


def test_coerced_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("",), (None,)], "v STRING")
    assert values(E.coerce_numbers(df, "v"), "v") == [1.5, None, None, None]


def test_dates(spark):
    rows = [(2024, 2, 29), (2023, 2, 29), (2024, 4, 31), (2024, 13, 1), (None, 1, 1), (2024, None, 1)]
    df = spark.createDataFrame(rows, "y INT, m INT, d INT")
    found = values(df, C.export_date(F.col("y"), F.col("m"), F.col("d")))
    assert found == [date(2024, 2, 29), None, None, None, None, None]
    month = values(df, C.export_date(F.col("y"), F.col("m")))
    assert month[:3] == [date(2024, 2, 1), date(2023, 2, 1), date(2024, 4, 1)]


@pytest.mark.parametrize(
    "text, name",
    [
        ("España", "ESPANA"),
        (" México D.F. ", "MEXICO DF"),
        ("Perú-1", "PERU"),
        ("Côte d'Ivoire", "COTE DIVOIRE"),
        ("", ""),
        (None, None),
    ],
)
def test_destination(spark, text, name):
    df = spark.createDataFrame([(text,)], "v STRING")
    assert values(df, C.destination_name(F.col("v"))) == [name]


@pytest.mark.parametrize(
    "text, group",
    [
        ("REGION METROPOLITANA", "Central"),
        ("Región de Valparaíso", "Central"),
        ("REGION DEL LIBERTADOR GRAL. B. O'HIGGINS", "Central"),
        ("Libertador O’Higgins", "Central"),
        ("Maule", "Central"),
        ("Región del Biobío", "South"),
        ("La Araucanía", "South"),
        ("Los Ríos", "South"),
        ("LOS LAGOS", "South"),
        ("Aysén", "Far South"),
        ("MAGALLANES", "Far South"),
        ("Antofagasta", "North"),
        ("ATACAMA", "North"),
        ("Coquimbo", "North"),
        ("Tarapacá", "Far North"),
        ("ARICA Y PARINACOTA", "Far North"),
        ("EXTRANJERA", "Other"),
        ("", "Other"),
        (None, "Other"),
    ],
)
def test_region_group(spark, text, group):
    df = spark.createDataFrame([(text,)], "v STRING")
    assert values(df, C.region_group(C.region_key(F.col("v")))) == [group]


def test_size_bands(spark):
    rows = [(1e6,), (999_999.99,), (1e5,), (1e4,), (9_999.99,), (None,)]
    df = spark.createDataFrame(rows, "v DOUBLE")
    assert values(df, C.size_band(F.col("v"))) == [
        "Large (>$1M)", "Medium ($100K-$1M)", "Medium ($100K-$1M)", "Small ($10K-$100K)",
        "Micro (<$10K)", "Micro (<$10K)",
    ]


def test_ratio_needs_both_positive(spark):
    df = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, -1.0), (0.0, 4.0)], "a DOUBLE, b DOUBLE")
    assert values(df, C.ratio_of_positives(F.col("a"), F.col("b"))) == [2.5, None, None, None]


def test_headers_exact_name_comes_first():
    names = E.canonical_names(["TOTAL US$ FOB", "US$ FOB UNIT", " us$ fob ", "Valor FOB USD"])
    assert names == ["TOTAL US$ FOB", "US$ FOB UNIT", "US$ FOB", "Valor FOB USD"]


def test_headers_first_similar_name_otherwise():
    names = E.canonical_names(["Valor FOB (USD)", "TOTAL FOB USD", "Peso Bruto Kg", "PESO BRUTO TOTAL"])
    assert names == ["US$ FOB", "TOTAL FOB USD", "PESO BRUTO", "PESO BRUTO TOTAL"]


@pytest.mark.parametrize("header", ["AÑO", "año", "ANO", "Year", "anio", "AÃ'O", " AÃ‘O "])
def test_year_headers(header):
    assert E.canonical_names([header]) == ["YEAR"]


@pytest.mark.parametrize(
    "header, name",
    [
        ("US_FOB", "US$ FOB"),
        ("PAIS_DESTINO", "PAIS DE DESTINO"),
        ("US$ Flete", "US$ FLETE"),
        ("Seguro USD", "US$ SEGURO"),
        ("CIF US$", "US$ CIF"),
        ("Descripcion Producto", "Descripcion Producto"),
        ("Cantidad Unidades Fisicas", "Cantidad Unidades Fisicas"),
        ("CANTIDAD DE BULTOS", "CANTIDAD"),
        ("Rut Exportador", "RUT PROBABLE EXPORTADOR"),
        ("Puerto Salida", "PUERTO EMBARQUE"),
        ("Puerto Desembarque", "PUERTO EMBARQUE"),
        ("Day", "DIA"),
        ("Month", "MES"),
        ("﻿Producto", "PRODUCTO"),
    ],
)
def test_similar_headers(header, name):
    assert E.canonical_names([header]) == [name]


def test_repeated_headers_stay_addressable():
    assert E.canonical_names(["X", "X", "X"]) == ["X", "X_2", "X_3"]


def test_clean_without_optional_columns(spark):
    df = spark.createDataFrame([("US$ 5", 2024, 3), ("-1", 2024, 3)], "`US$ FOB` STRING, YEAR INT, MES INT")
    cleaned = E.clean_exports(df)
    assert cleaned.columns == [
        "US$ FOB", "YEAR", "MES", "FOB_CLEAN", "EXPORT_DATE", "EXPORT_SIZE_CATEGORY"
    ]
    assert [row.EXPORT_DATE for row in cleaned.collect()] == [date(2024, 3, 1)]


def test_empty_filter_keeps_all(spark):
    df = spark.range(5)
    assert E.filter_in(df, "id", []).count() == 5
    assert E.filter_in(df, "id", None).count() == 5
    assert E.filter_in(df, "id", [1, 2]).count() == 2


def test_value_column_falls_back(spark):
    raw = spark.createDataFrame([("US$ 3", 9.0), ("x", 8.0)], "`US$ FOB` STRING, FOB_CLEAN DOUBLE")
    assert values(raw, E.value_column(raw)) == [9.0, 8.0]
    only_raw = raw.drop("FOB_CLEAN")
    assert values(only_raw, E.value_column(only_raw)) == [3.0, None]


def test_audit_columns(spark):
    row = E.with_audit(spark.range(1), datetime(2025, 1, 2, 3, 4, 5)).first()
    assert row.PROCESSED_AT == datetime(2025, 1, 2, 3, 4, 5)
    assert row.PROCESSING_DATE == date(2025, 1, 2)


def test_sample_falls_back_to_first_columns(spark):
    wide = spark.range(20).select(*[F.col("id").alias(f"c{i}") for i in range(12)])
    assert len(E.sample_rows(wide).columns) == 10
    assert E.sample_rows(wide).count() == 10
    named = spark.range(20).select(F.lit(2024).alias("YEAR"), "id")
    assert E.sample_rows(named).columns == ["YEAR"]


def test_dates_as_text(spark):
    df = spark.createDataFrame([("2024", "03", " 9"), ("x", "1", "1")], "YEAR STRING, MES STRING, DIA STRING")
    rows = E.clean_exports(df).collect()
    assert [(r.YEAR, r.MES, r.DIA, r.EXPORT_DATE) for r in rows] == [
        (2024, 3, 9, date(2024, 3, 9)), (None, 1, 1, None)
    ]


def test_month_of_three_digits_is_no_date(spark):
    df = spark.createDataFrame([("2024", "113", "5"), ("2024", "11", "310"), ("2024", "1", "5")], "y string, m string, d string")
    found = values(df, C.export_date(F.col("y"), F.col("m"), F.col("d")))
    assert [x is None for x in found] == [True, True, False]
