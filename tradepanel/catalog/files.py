"""Files and tables, written from the given tables and read back."""

from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..operators import marts, panel
from ..operators.exports import clean_exports, normalise_headers, sample_rows
from ..schemas import IMPORTANCES
from ..session import new_folder
from ..sources import export_files, files, gdp_files, tables
from ..streaming import exports as stream
from .adapter import ALL_COLUMNS, RUN_AT
from .ctes import total
from .registry import query


def as_read(name):
    """A field as text; CSV does not tell blank from missing, both are read as null."""
    return f"nullif(CAST(\"{name}\" AS VARCHAR), '')"


FILE_COLUMNS = [name for name in ALL_COLUMNS if name != "SOURCE_FILE"]
RAW_SQL = ", ".join(f'{as_read(name)} AS "{name}"' for name in ALL_COLUMNS)
# Files of later years carry no quantity.
FILE_SQL = ", ".join(
    f'CASE WHEN "YEAR" <= 2020 THEN {as_read(name)} END AS "{name}"'
    if name == "CANTIDAD"
    else f'{as_read(name)} AS "{name}"'
    for name in FILE_COLUMNS
)


def landed(t):
    """Lines to 2020 in UTF-8, later ones in Latin-1 with other, fewer and
    differently ordered headers, and the lines of one year with no FOB at all."""
    folder = new_folder(t.spark, "landing")
    raw = t.raw(*FILE_COLUMNS).withColumn("YEAR", F.col("YEAR").cast("string"))
    early, late = raw.filter("YEAR <= '2020'"), raw.filter("YEAR > '2020'")
    tables.write_csv(early, f"{folder}/early")
    spelled = {"YEAR": "Año", "US$ FOB": " us$ fob ", "PAIS DE DESTINO": "Pais Destino"}
    others = late.select(*[C.named(n) for n in reversed(FILE_COLUMNS) if n != "CANTIDAD"])
    tables.write_csv(others.withColumnsRenamed(spelled), f"{folder}/late", encoding="ISO-8859-1")
    tables.write_csv(late.drop("US$ FOB"), f"{folder}/without_fob")
    return folder


@query("s1_scan_export_csv", f"SELECT {RAW_SQL} FROM raw")
def s1(t):
    path = tables.write_csv(t.raw(), new_folder(t.spark, "csv"))
    return export_files.read_csv(t.spark, path, ALL_COLUMNS)


PROCESSED = ("YEAR", "MES", "FOB_CLEAN", "PAIS_DESTINO_CLEAN", "EXPORT_SIZE_CATEGORY")
PROCESSED_SQL = f"SELECT {', '.join(PROCESSED)} FROM clean"


def processed(t):
    path = new_folder(t.spark, "exports")
    tables.write_table(t.clean("YEAR", "MES", "US$ FOB", "PAIS DE DESTINO"), path, by="YEAR")
    return tables.read_table(t.spark, path).select(*PROCESSED)


@query("s2_scan_processed", PROCESSED_SQL)
def s2(t):
    return processed(t)


@query("s2_scan_later_years", f"{PROCESSED_SQL} WHERE YEAR >= 2019")
def s2_later(t):
    """Of the stored table only the folders of these years are read."""
    return processed(t).filter("YEAR >= 2019")


@query("s3_mixed_encodings", f"SELECT {FILE_SQL} FROM raw")
def s3(t):
    return export_files.ingest(t.spark, landed(t), RUN_AT).select(
        *[C.named(name) for name in FILE_COLUMNS]
    )


@query(
    "s4_file_admission",
    """SELECT 'UTF-8' AS encoding, true AS has_fob, true AS has_country, true AS has_product,
         true AS valid, count(*) AS records FROM raw WHERE "YEAR" <= 2020
       UNION ALL SELECT 'ISO-8859-1', true, true, true, true, count(*) FROM raw WHERE "YEAR" > 2020
       UNION ALL SELECT 'UTF-8', false, true, true, false, count(*) FROM raw WHERE "YEAR" > 2020""",
)
def s4(t):
    """Lines below the headers, by what was found out about their file."""
    found = export_files.inspect_files(t.spark, landed(t))
    return found.groupBy("encoding", "has_fob", "has_country", "has_product", "valid").agg(
        F.sum(F.col("lines") - 1).alias("records")
    )


@query("s5_normalised_headers", 'SELECT "MES", "PRODUCTO", "US$ FOB" FROM raw')
def s5(t):
    return normalise_headers(t.raw("MES", "PRODUCTO", "US$ FOB").toDF(" mes", "Producto ", "us$ Fob"))


@query(
    "s6_provenance",
    """SELECT '2025-01-15 06:00:00' AS extracted, count(*) AS records, count(*) AS with_file
       FROM raw""",
)
def s6(t):
    found = export_files.ingest(t.spark, landed(t), RUN_AT)
    at = F.date_format("EXTRACTION_DATE", "yyyy-MM-dd HH:mm:ss").alias("extracted")
    return found.groupBy(at).agg(
        F.count("*").alias("records"),
        F.count(F.when(F.col("SOURCE_FILE").like("part-%.csv"), 1)).alias("with_file"),
    )


@query(
    "s7_combined_layouts",
    f"""SELECT "YEAR", count(*) AS records, {total('"FOB_CLEAN"')} AS total_fob_usd,
        count(CASE WHEN "YEAR" <= 2020 THEN "CANTIDAD" END) AS with_quantity
        FROM parsed GROUP BY "YEAR" """,
)
def s7(t):
    raw = export_files.ingest(t.spark, landed(t), RUN_AT)
    lines = clean_exports(raw, keep_all=True)
    return lines.groupBy(F.col("YEAR").cast("int").alias("YEAR")).agg(
        F.count("*").alias("records"),
        marts.total(F.col("FOB_CLEAN")).alias("total_fob_usd"),
        F.count("CANTIDAD").alias("with_quantity"),
    )


def pages(t):
    """One response page per year. A page holds one record per country."""
    folder = new_folder(t.spark, "pages")
    records = t.records()
    meta = F.struct(F.lit(1).alias("page"), F.count("*").alias("total"))
    body = F.concat(
        F.lit("["), F.to_json(meta), F.lit(","),
        F.to_json(
            F.collect_list(F.struct(*records.columns)), {"ignoreNullFields": "false"}
        ),
        F.lit("]"),
    )
    by_year = records.groupBy("date").agg(body.alias("value"))
    by_year.repartition("date").write.partitionBy("date").text(folder)
    return folder


NESTED_SQL = """countryiso3code, date, value, country_id, country_name, indicator_code,
    indicator_name"""


def flat(df):
    return df.select(
        "countryiso3code", "date", "value", F.col("country.id").alias("country_id"),
        F.col("country.value").alias("country_name"), F.col("indicator.id").alias("indicator_code"),
        F.col("indicator.value").alias("indicator_name"),
    )


@query("s8_nested_json", f"SELECT {NESTED_SQL} FROM records")
def s8(t):
    return flat(gdp_files.read_records(t.spark, pages(t)))


@query("s9_valid_records", f"SELECT {NESTED_SQL} FROM valid_records")
def s9(t):
    return flat(panel.valid_records(t.records()))


@query("s10_nested_projection", "SELECT * FROM flat_records")
def s10(t):
    return gdp_files.read_gdp(t.spark, pages(t))


FALLBACK_SQL = """SELECT country_code, year, gdp_value FROM flat_records
    WHERE year >= coalesce((SELECT max(year) FROM (SELECT year FROM flat_records
      GROUP BY year HAVING count(*) > {enough})), 0)"""


@query("s11_year_fallback", FALLBACK_SQL.format(enough=100))
def s11(t):
    rows = tables.stored(panel.project_records(panel.valid_records(t.records())), "records")
    return panel.years_until_enough(rows).select("country_code", "year", "gdp_value")


@query("s11_year_fallback_stops", FALLBACK_SQL.format(enough=20))
def s11_stops(t):
    rows = tables.stored(panel.project_records(panel.valid_records(t.records())), "records")
    return panel.years_until_enough(rows, 20).select("country_code", "year", "gdp_value")


@query("s11_years_from_folders", FALLBACK_SQL.format(enough=20))
def s11_folders(t):
    """The same from pages, of which those of earlier years are not opened."""
    found = gdp_files.read_until_enough(t.spark, pages(t), 20)
    return found.select("country_code", "year", "gdp_value")


@query("s12_years_together", "SELECT * FROM flat_records")
def s12(t):
    folder = pages(t)
    years = [row.date for row in t.records().select("date").distinct().collect()]
    return gdp_files.append_years(
        [gdp_files.read_gdp(t.spark, f"{folder}/date={year}") for year in sorted(years)]
    )


@query("s13_csv_sink", "SELECT * FROM monthly")
def s13(t):
    path = tables.write_csv(t.monthly(), new_folder(t.spark, "mart"), single_file=True)
    return t.spark.read.schema(t.monthly().schema).option("header", "true").csv(path)


@query("s14_snapshot_sink", "SELECT country_code, year, gdp_value FROM panel")
def s14(t):
    folder = new_folder(t.spark, "snapshots")
    tables.write_snapshot(t.panel(), folder, RUN_AT)
    return tables.read_table(t.spark, folder).select("country_code", "year", "gdp_value")


@query(
    "s15_append",
    """SELECT country_code, year, gdp_value FROM gdp UNION ALL
       SELECT country_code, year, gdp_value FROM gdp""",
)
def s15(t):
    path = new_folder(t.spark, "appended")
    for _ in range(2):
        tables.append_table(t.gdp().select("country_code", "year", "gdp_value"), path)
    return tables.read_table(t.spark, path)


@query(
    "s16_replace_by_year",
    """SELECT country_code, gdp_value * CASE WHEN year >= 2022 THEN 2 ELSE 1 END AS gdp_value, year
       FROM gdp""",
)
def s16(t):
    """All years, then new figures of the last ones, the latter loaded twice."""
    rows = tables.stored(t.gdp().select("country_code", "gdp_value", "year"), "records")
    path = tables.replace_partitions(rows, new_folder(t.spark, "panel"))
    newer = rows.filter("year >= 2022").withColumn("gdp_value", F.col("gdp_value") * 2)
    for _ in range(2):
        tables.replace_partitions(newer, path)
    return tables.read_table(t.spark, path)


@query(
    "s17_sql_scan",
    """SELECT region, count(*) AS rows, max(gdp_value) AS max_gdp FROM panel GROUP BY region""",
)
def s17(t):
    return tables.scan_sql(
        t.spark,
        "SELECT region, count(*) AS rows, max(gdp_value) AS max_gdp FROM {panel} GROUP BY region",
        panel=t.panel(),
    )


@query("s18_latest_snapshot", "SELECT * FROM monthly")
def s18(t):
    """Two CSV marts in one folder; the newer one is found by its name and time."""
    folder = new_folder(t.spark, "marts")
    tables.write_csv(t.regional(), f"{folder}/regional_export_performance", single_file=True)
    monthly = t.monthly()
    tables.write_csv(monthly, f"{folder}/monthly_exports_by_country", single_file=True)
    newest = files.latest_file(t.spark, folder, "monthly_exports_by_country").first().path
    return t.spark.read.schema(monthly.schema).option("header", "true").csv(newest)


@query("s19_latest_artifact", "SELECT country_code, year, gdp_value FROM panel")
def s19(t):
    folder = new_folder(t.spark, "models")
    rows = t.panel().select("country_code", "year", "gdp_value")
    tables.write_json(rows.filter("year = 2018").repartition(1), f"{folder}/sample_20240101_000000")
    tables.write_json(rows.repartition(1), f"{folder}/sample_20250115_060000")
    path = files.latest_artifact(t.spark, folder, "sample").first().path
    return t.spark.read.schema(rows.schema).json(path)


@query(
    "s20_record_counts",
    """SELECT 'gdp' AS data_source, count(*) AS record_count FROM panel
       UNION ALL SELECT 'exports', count(*) FROM clean""",
)
def s20(t):
    folder = new_folder(t.spark, "warehouse")
    tables.write_table(t.panel(), f"{folder}/gdp")
    tables.write_table(t.clean("US$ FOB"), f"{folder}/exports")
    found = files.last_update(t.spark, {name: f"{folder}/{name}" for name in ("gdp", "exports")})
    return found.filter(F.col("last_update").isNotNull()).select("data_source", "record_count")


@query(
    "s21_json_artifact",
    """SELECT country_code AS feature, CAST(count(*) AS DOUBLE) AS importance
       FROM panel GROUP BY country_code""",
)
def s21(t):
    rows = t.panel().groupBy(F.col("country_code").alias("feature")).agg(
        F.count("*").cast("double").alias("importance")
    )
    path = tables.write_json(rows, new_folder(t.spark, "importance"))
    return tables.read_json(t.spark, path, IMPORTANCES)


@query(
    "s22_minimum_rows",
    """SELECT 'exports' AS dataset, count(*) >= 50 AS enough, count(*) > 0 AS any_rows FROM raw
       UNION ALL SELECT 'newest year', count(*) >= 50, count(*) > 0 FROM panel
         WHERE year = (SELECT max(year) FROM panel)""",
)
def s22(t):
    latest = panel.latest_year(t.stored_panel())
    rows = [
        (name, tables.has_rows(df, 50), tables.has_rows(df))
        for name, df in (("exports", t.raw("ITEM")), ("newest year", latest))
    ]
    return t.spark.createDataFrame(rows, "dataset STRING, enough BOOLEAN, any_rows BOOLEAN")


@query("s23_write_if_any", "SELECT * FROM regional")
def s23(t):
    folder = new_folder(t.spark, "marts")
    mart = t.regional()
    written = {
        "full": tables.write_if_any(mart, f"{folder}/full"),
        "empty": tables.write_if_any(mart.filter(F.lit(False)), f"{folder}/empty"),
    }
    kept = [f"{folder}/{name}" for name, has_rows in written.items() if has_rows]
    return t.spark.read.parquet(*kept)


@query(
    "s24_seeded_twice",
    """SELECT analysis_type, count(*) AS rows FROM export_analytics GROUP BY 1
       UNION ALL SELECT 'regional_reference', 10""",
)
def s24(t):
    facts = t.export_analytics()
    once = tables.stored(tables.seed_reference_regions(facts), "analytics")
    twice = tables.seed_reference_regions(once)
    return twice.groupBy("analysis_type").agg(F.count("*").alias("rows"))


@query(
    "s25_sample_rows",
    """SELECT "YEAR", "MES", "PAIS_DESTINO_CLEAN", "PRODUCTO_CLEAN", "FOB_CLEAN", "EXPORT_SIZE_CATEGORY",
         "REGION_ORIGEN_CLEAN" FROM clean
       ORDER BY 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST, 4 NULLS FIRST, 5, 6, 7 NULLS FIRST LIMIT 10""",
)
def s25(t):
    return sample_rows(t.clean())


@query("x1_stream", """SELECT "YEAR", "MES", "FOB_CLEAN", "PAIS_DESTINO_CLEAN" FROM clean""")
def x1(t):
    """The lines arrive in two halves; the second run reads only the new files."""
    columns = ["YEAR", "MES", "US$ FOB", "PAIS DE DESTINO"]
    folder = new_folder(t.spark, "stream")
    raw = t.raw(*columns)
    for half, condition in enumerate(("YEAR <= 2020", "YEAR > 2020")):
        tables.write_csv(raw.filter(condition), f"{folder}/in/{half}")
        lines = stream.read_stream(t.spark, f"{folder}/in/*", columns, RUN_AT)
        running = stream.clean_available(lines, f"{folder}/out", f"{folder}/checkpoint")
        running.awaitTermination()
    return tables.read_table(t.spark, f"{folder}/out").select(
        F.col("YEAR").cast("int").alias("YEAR"), F.col("MES").cast("int").alias("MES"),
        "FOB_CLEAN", "PAIS_DESTINO_CLEAN",
    )
