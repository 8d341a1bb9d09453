"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# The declared columns of the raw export declarations, with their
# declared types. The raw files are read as text; the types drive check DQ9.
EXPORT_COLUMNS = {
    "DIA": "int",
    "MES": "int",
    "YEAR": "int",
    "NUMERO DE ACEPTACION": "varchar(50)",
    "ADUANA": "varchar(100)",
    "RUT PROBABLE EXPORTADOR": "varchar(20)",
    "DV PROBABLE EXPORTADOR": "varchar(5)",
    "PARTIDA ARANCELARIA": "varchar(20)",
    "PRODUCTO": "text",
    "VARIEDAD": "varchar(255)",
    "MARCA": "varchar(255)",
    "DESCRIPCION": "text",
    "PAIS DE DESTINO": "varchar(100)",
    "VIA DE TRANSPORTE": "varchar(100)",
    "COMPANIA DE TRANSPORTE": "varchar(255)",
    "NAVE": "varchar(255)",
    "TIPO DE CARGA": "varchar(100)",
    "PUERTO EMBARQUE": "varchar(100)",
    "PUERTO DESEMBARQUE": "varchar(100)",
    "CLAUSULA DE VENTA": "varchar(50)",
    "FORMA DE PAGO": "varchar(100)",
    "PESO BRUTO": "decimal(15,3)",
    "ITEM": "int",
    "CANTIDAD": "decimal(15,3)",
    "UNIDAD": "varchar(50)",
    "US$ FOB": "decimal(15,2)",
    "US$ FLETE": "decimal(15,2)",
    "US$ SEGURO": "decimal(15,2)",
    "US$ CIF": "decimal(15,2)",
    "US$ FOB UNIT": "decimal(15,4)",
    "TIPO DE BULTO": "varchar(100)",
    "TIPO DE OPERACIÓN": "varchar(100)",
    "DESCRIPCION ARANCELARIA": "text",
    "COMUNA EXPORTADOR": "varchar(100)",
    "REGION DE ORIGEN": "varchar(100)",
    "CANTIDAD DE BULTOS": "int",
    "DESCRIPCIÓN DE BULTO": "text",
    "PAIS COMPAÑIA DE TRANSPORTE": "varchar(100)",
    "MODALIDAD DE VENTA": "varchar(100)",
    "TOTAL ITEMS": "int",
    "PESO BRUTO TOTAL": "decimal(15,3)",
    "TOTAL US$ FOB": "decimal(15,2)",
    "ZONA ECONOMICA": "varchar(100)",
    "CLAVE ECONOMICA": "varchar(20)",
    "NUM DOC TRANSPORTE": "varchar(100)",
    "FECHA DOC TRANSPORTE": "varchar(20)",
    "NUM DE VIAJE": "varchar(100)",
    "CANTIDAD UNIDADES FISICAS": "decimal(15,3)",
    "UNIDAD DE MEDIDA FISICA": "varchar(50)",
    "EMISOR": "varchar(255)",
    "TOTAL US$ FLETE": "decimal(15,2)",
    "TOTAL US$ SEGURO": "decimal(15,2)",
    "TOTAL US$ CIF": "decimal(15,2)",
}

PROVENANCE_COLUMNS = ("SOURCE_FILE", "EXTRACTION_DATE")


def all_text(columns) -> T.StructType:
    """A schema that reads every named column as text."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


RAW_EXPORTS = all_text([*EXPORT_COLUMNS, *PROVENANCE_COLUMNS])

# The second element of a GDP response page.
_CODED = "STRUCT<id: STRING, value: STRING>"
GDP_RECORDS = (
    "ARRAY<STRUCT<countryiso3code: STRING, date: STRING, value: STRING, "
    f"country: {_CODED}, indicator: {_CODED}>>"
)

EXPORT_ANALYTICS = (
    "analysis_type STRING, year INT, month INT, region STRING, country STRING, product STRING, "
    "total_fob_usd DOUBLE, export_count BIGINT, avg_fob_usd DOUBLE, unique_exporters BIGINT, "
    "unique_destinations BIGINT"
)

MODEL_REGISTRY = (
    "model_name STRING, model_version STRING, model_type STRING, training_date TIMESTAMP, "
    "accuracy_score DOUBLE, feature_names ARRAY<STRING>, model_path STRING, data_period STRING, "
    "countries_count BIGINT, training_samples BIGINT, test_samples BIGINT"
)

MODEL_METADATA = (
    "model_name STRING, model_version STRING, model_type STRING, training_date STRING, "
    "feature_names ARRAY<STRING>, performance_metrics MAP<STRING, DOUBLE>, "
    "training_samples BIGINT, test_samples BIGINT, hyperparameters MAP<STRING, STRING>, model_path STRING"
)

IMPORTANCES = "feature STRING, importance DOUBLE"
