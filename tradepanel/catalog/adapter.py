"""The given order tables seen as export declarations and GDP records.

Amounts, blanks, accents and impossible dates are set so that every branch of the
cleaning is taken. Lookups are left joins, and only the tables that the wanted
columns come from are joined; orders meet customers before they meet lines.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import cleaning as C
from ..operators import features, learning, marts, rollup
from ..operators.exports import clean_exports
from ..operators.panel import build_panel
from ..sources.tables import stored

RUN_AT = datetime(2025, 1, 15, 6, 0, 0)

# Columns that are read from the given tables; named here, so that no job has to
# look them up in the files.
SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "part": "p_partkey BIGINT, p_name STRING",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
}

# Region names by supplier nation mod 17; the last is missing.
REGION_NAMES = (
    "REGION METROPOLITANA", "Región de Valparaíso", "REGION DEL LIBERTADOR GRAL. B. O'HIGGINS",
    "REGION DEL MAULE", "Región del Biobío", "REGION DE LA ARAUCANIA", "REGION DE LOS RIOS",
    "REGION DE LOS LAGOS", "Región de Aysén", "REGION DE MAGALLANES", "REGION DE ANTOFAGASTA",
    "REGION DE ATACAMA", "REGION DE COQUIMBO", "Región de Tarapacá",
    "REGION DE ARICA Y PARINACOTA", "EXTRANJERA", None,
)
# Country code by customer nation.
COUNTRY_CODES = (
    "USA", "BRA", "DEU", "CHN", "NGA", "AUS", "SAU", "CAN", "ARG", "FRA", "JPN", "ZAF", "NZL",
    "IRN", "MEX", "CHL", "GBR", "IND", "EGY", "FJI", "ARE", "WLD", "EUU", "XKX", "HIC",
)
INDICATOR = ("NY.GDP.MKTP.CD", "GDP (current US$)")


def _text(column):
    return column.cast("string")


def _year():
    return (F.year("o_orderdate") + 23).cast("int")


def _fob():
    turn = F.col("l_linenumber") % 3
    factor = F.when(turn == 0, 1).when(turn == 1, 10).otherwise(100)
    price = (F.col("l_extendedprice").cast("decimal(18,2)") * factor).cast("decimal(18,2)")
    signed = F.when(F.col("l_orderkey") % 89 == 0, -price).otherwise(price)
    return F.when(F.col("l_orderkey") % 97 != 0, F.concat(F.lit("US$ "), _text(signed)))


def _region():
    names = F.array(*[F.lit(name) for name in REGION_NAMES])
    return F.element_at(names, F.col("s_nationkey") % 17 + 1)


# Column: the tables it needs and its expression.
RAW = {
    "NUMERO DE ACEPTACION": ((), lambda: _text(F.col("l_orderkey"))),
    "ITEM": ((), lambda: F.col("l_linenumber")),
    "YEAR": (("orders",), _year),
    "MES": (("orders",), lambda: F.month("o_orderdate")),
    "DIA": (
        ("orders",),
        lambda: F.when(F.col("l_linenumber") == 7, 31).otherwise(F.dayofmonth("o_orderdate")),
    ),
    "US$ FOB": ((), _fob),
    "PESO BRUTO": (
        (),
        lambda: F.when(F.col("l_orderkey") % 83 == 0, "").otherwise(_text(F.col("l_quantity"))),
    ),
    "CANTIDAD": ((), lambda: _text(F.col("l_linenumber"))),
    "PAIS DE DESTINO": (
        ("customer",),
        lambda: F.concat(F.lit(" nation "), F.char(F.col("c_nationkey") + 65)),
    ),
    "PRODUCTO": (("part",), lambda: F.concat("p_name", F.lit(" "))),
    "REGION DE ORIGEN": (("supplier",), _region),
    "RUT PROBABLE EXPORTADOR": (
        ("orders",),
        lambda: F.when(F.col("o_custkey") % 71 != 0, _text(F.col("o_custkey"))),
    ),
    "SOURCE_FILE": (("orders",), lambda: F.concat(F.lit("exports_"), _text(_year()))),
}
ALL_COLUMNS = tuple(RAW)
NATION = "nation key"
# True for one of the rows that a line gives where a part or supplier key repeats.
FIRST, COPY = "first row of a line", "copy__"


def with_copy_number(df: DataFrame, key: str) -> DataFrame:
    """Rows that have the key, numbered from 1 within it; others meet no line."""
    number = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return df.filter(F.col(key).isNotNull()).withColumn(f"{COPY}{key}", number)

_trained: dict = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def raw(self, *columns: str) -> DataFrame:
        """The wanted columns of the raw export lines; all if none are named."""
        columns = columns or ALL_COLUMNS
        needed = {table for name in columns if name in RAW for table in RAW[name][0]}
        if NATION in columns:
            needed.add("customer")
        lines = self.read("lineitem")
        if needed & {"orders", "customer"}:
            orders = self.read("orders")
            if "customer" in needed:
                customer = self.read("customer")
                orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
            lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        if "part" in needed:
            part = self.read("part")
            if FIRST in columns:
                part = with_copy_number(part, "p_partkey")
            lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        if "supplier" in needed:
            supplier = self.read("supplier")
            if FIRST in columns:
                supplier = with_copy_number(supplier, "s_suppkey")
            lines = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        chosen = {name: RAW[name][1]() for name in columns if name in RAW}
        if NATION in columns:
            chosen[NATION] = F.col("c_nationkey")
        if FIRST in columns:
            numbers = [F.coalesce(F.col(name), F.lit(1)) for name in lines.columns if name.startswith(COPY)]
            chosen[FIRST] = F.greatest(F.lit(1), F.lit(1), *numbers) == 1
        return lines.select(*[chosen[name].alias(name) for name in columns])

    def clean(self, *columns: str, keep_all: bool = False) -> DataFrame:
        """Clean export lines from the named raw columns; all if none are named."""
        return clean_exports(self.raw(*columns), keep_all)

    def spellings(self) -> DataFrame:
        """Positive lines summed up by year, nation and the spellings of their labels, and
        written once: for the panel and the yearly features, which clean each spelling
        instead of each line. ``once`` are the sums without the further rows of a line
        whose part or supplier key repeats, which the panel does not join."""
        keys = (NATION, "YEAR", "PAIS DE DESTINO", "PRODUCTO", "REGION DE ORIGEN")
        lines, fob = self.clean("US$ FOB", FIRST, *keys), F.col("FOB_CLEAN")
        sums = {"fob": (fob, 2), "once": (F.when(C.named(FIRST), fob), 2)}
        return rollup.pre_aggregate(lines, [C.named(name) for name in keys], **sums)

    def gdp(self, spellings: DataFrame | None = None) -> DataFrame:
        """Flat GDP records: positive FOB per destination and year, scaled; from the lines,
        or from what they were summed up to."""
        if spellings is None:
            lines, fob = self.clean(NATION, "YEAR", "US$ FOB"), F.sum(F.col("FOB_CLEAN").cast("decimal(28,2)")).cast("double")
        else:
            lines, fob = spellings, rollup.total("once")
        sums = lines.groupBy(F.col(NATION), F.col("YEAR").alias("year")).agg(fob.alias("fob"))
        scale = F.element_at(
            F.array(*[F.lit(s) for s in (10.0, 100.0, 1000.0, 10000.0)]), F.col(NATION) % 4 + 1
        )
        codes = F.array(*[F.lit(code) for code in COUNTRY_CODES])
        nation = self.read("nation").select(F.col("n_nationkey").alias(NATION), "n_name")
        return sums.join(nation, NATION, "left").select(
            F.element_at(codes, F.col(NATION) + 1).alias("country_code"),
            F.col("n_name").alias("country_name"),
            F.lit(INDICATOR[0]).alias("indicator_code"),
            F.lit(INDICATOR[1]).alias("indicator_name"),
            "year",
            (F.col("fob") * scale).alias("gdp_value"),
        )

    def records(self) -> DataFrame:
        """The same as nested response records: text values, one country group
        without a code, and one without a value in its first year."""
        missing = (F.col("country_code") == "EUU") & (F.col("year") == 2018)
        return self.gdp().select(
            F.when(F.col("country_code") == "HIC", "").otherwise(F.col("country_code")).alias(
                "countryiso3code"
            ),
            _text(F.col("year")).alias("date"),
            F.when(~missing, _text(F.col("gdp_value").cast("decimal(28,2)"))).alias("value"),
            F.struct(
                F.col("country_code").alias("id"), F.col("country_name").alias("value")
            ).alias("country"),
            F.struct(
                F.col("indicator_code").alias("id"), F.col("indicator_name").alias("value")
            ).alias("indicator"),
        )

    def panel(self) -> DataFrame:
        return build_panel(self.gdp())

    def stored_panel(self) -> DataFrame:
        """The panel as a written table, as queries that read it twice have it."""
        return stored(self.panel(), "panel")

    def monthly(self) -> DataFrame:
        return marts.monthly_by_destination(
            self.clean("YEAR", "MES", "US$ FOB", "PESO BRUTO", "PAIS DE DESTINO",
                       "RUT PROBABLE EXPORTADOR")
        )

    def regional(self) -> DataFrame:
        return marts.regional_by_year(
            self.clean("YEAR", "US$ FOB", "PAIS DE DESTINO", "PRODUCTO", "REGION DE ORIGEN")
        )

    def product(self) -> DataFrame:
        return marts.product_by_year(
            self.clean("YEAR", "US$ FOB", "PESO BRUTO", "PAIS DE DESTINO", "PRODUCTO")
        )

    def export_analytics(self) -> DataFrame:
        """The three marts in one table. The lines are cleaned once and stored, as in
        the export job; each mart reads the columns it needs."""
        lines = stored(
            self.clean("YEAR", "MES", "US$ FOB", "PESO BRUTO", "PAIS DE DESTINO", "PRODUCTO",
                       "REGION DE ORIGEN", "RUT PROBABLE EXPORTADOR"),
            "exports",
        )
        pre = marts.pre_aggregate(lines)
        return marts.export_analytics(
            marts.monthly_by_destination(lines), marts.regional_by_year(lines, pre),
            marts.product_by_year(lines, pre),
        )

    def yearly(self) -> DataFrame:
        return marts.yearly_features(self.yearly_lines())

    def yearly_lines(self) -> DataFrame:
        return self.clean("YEAR", "US$ FOB", "PAIS DE DESTINO", "PRODUCTO", "REGION DE ORIGEN")

    def averages(self) -> DataFrame:
        return marts.yearly_averages(
            self.raw("YEAR", "US$ FOB", "PESO BRUTO", "PAIS DE DESTINO", "PRODUCTO",
                     "REGION DE ORIGEN")
        )

    def short_features(self) -> DataFrame:
        """Both sides from the lines summed up by spelling: they are read, joined and
        cleaned once."""
        spellings = self.spellings()
        cleaned = clean_exports(spellings)
        return features.short_features(build_panel(self.gdp(spellings)), cleaned, cleaned)

    def trained(self) -> learning.Trained:
        """The boosted model with its usual settings, trained once per session for
        the queries that only read what training leaves behind."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _trained:
            _trained[key] = learning.train(self.short_features())
        return _trained[key]
