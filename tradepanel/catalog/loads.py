"""S1, S4, S15, S16, S23, A7, A15, DQ1: files with line breaks, malformed records and
refused files, and the export job run twice over a folder that grows."""

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..operators.exports import filter_in
from ..plans import exports as job
from ..session import new_folder, scratch
from ..sources import export_files, tables
from ..streaming import loads
from .adapter import RUN_AT
from .ctes import number, total
from .registry import query

LATER = datetime(2025, 1, 16, 6, 0, 0)
COLUMNS = ("NUMERO DE ACEPTACION", "ITEM", "YEAR", "MES", "US$ FOB", "PESO BRUTO", "PAIS DE DESTINO", "PRODUCTO",
           "REGION DE ORIGEN", "RUT PROBABLE EXPORTADOR")
BROKEN = """CASE "ITEM" % 4 WHEN 0 THEN "PRODUCTO" WHEN 1 THEN 'two' || chr(10) || "PRODUCTO"
    WHEN 2 THEN 'a "quoted, ' || chr(10) || chr(10) || '" ' || "PRODUCTO" ELSE '"' END"""


def broken(t):
    """Lines whose product holds line breaks, quotes and separators."""
    lines = t.raw("NUMERO DE ACEPTACION", "ITEM", "US$ FOB", "PAIS DE DESTINO", "PRODUCTO")
    item, product = F.col("ITEM") % 4, F.col("PRODUCTO")
    text = (
        F.when(item == 0, product)
        .when(item == 1, F.concat(F.lit("two\n"), product))
        .when(item == 2, F.concat(F.lit('a "quoted, \n\n" '), product))
        .otherwise('"')
    )
    return lines.withColumn("PRODUCTO", text)


@query("s1_quoted_line_breaks", f"""SELECT "NUMERO DE ACEPTACION", CAST("ITEM" AS VARCHAR) AS "ITEM", {BROKEN} AS "PRODUCTO" FROM raw""")
def s1_breaks(t):
    """All lines in one file, or as many as large ones as they need, read in splits."""
    folder = new_folder(t.spark, "breaks")
    tables.write_csv(broken(t).repartition(large_files(t)), folder)
    found = export_files.ingest(t.spark, folder, RUN_AT)
    return found.select(*[C.named(n) for n in ("NUMERO DE ACEPTACION", "ITEM", "PRODUCTO")])


#: Lines of a landed file, about: some splits, and what one task writes in good time.
FILE_LINES = 4_000_000


def large_files(t):
    """How many files the lines make."""
    return max(1, -(-t.read("lineitem").count() // FILE_LINES))


def write_lines(rows, folder, header, files=1):
    """CSV files of the lines of a text column as they are, below the header. The rows are
    made by many tasks; only a file is written by one."""
    lines = rows.repartition(files).select(F.explode(F.split("value", "\n")).alias(header))
    bare = {"header": "true", "quote": "", "escapeQuotes": "false", "sep": "\u0001", "emptyValue": ""}
    bare |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines.write.options(**bare).csv(folder)


@query(
    "s1_malformed_records",
    """SELECT count(*) FILTER ("ITEM" = 3) AS surplus, count(*) FILTER ("ITEM" = 5) AS short,
         count(*) FILTER ("ITEM" NOT IN (3, 5)) AS whole FROM raw""",
)
def s1_malformed(t):
    """Records of items 3 have a field too many, those of items 5 one too few."""
    lines = t.raw("ITEM", "PAIS DE DESTINO", "PRODUCTO")
    quoted = F.concat(F.lit('"'), F.col("PRODUCTO"), F.lit(', and\n""more"""'))
    text = F.concat_ws(",", F.col("ITEM"), C.named("PAIS DE DESTINO"), F.lit("1.5"), F.when(F.col("ITEM") != 5, quoted))
    rows = lines.select(F.when(F.col("ITEM") == 3, F.concat(text, F.lit(",x"))).otherwise(text).alias("value"))
    folder = new_folder(t.spark, "malformed")
    write_lines(rows, folder, 'ITEM,PAIS DE DESTINO,"US$ FOB",PRODUCTO', large_files(t))
    raw = tables.stored(export_files.ingest(t.spark, folder, RUN_AT, malformed=True), "malformed")
    bad = export_files.malformed_rows(raw).agg(F.sum("surplus").alias("surplus"), F.sum("short").alias("short"))
    whole = raw.agg(F.count(F.when(F.col(export_files.MALFORMED).isNull(), 1)).alias("whole"))
    return bad.crossJoin(whole)


@query(
    "s4_refused_files",
    """SELECT 'no FOB column' AS reason, CAST(count(*) AS BIGINT) AS records FROM raw WHERE "YEAR" <= 2020
       UNION ALL SELECT 'no FOB column, no destination column', count(*) FROM raw WHERE "YEAR" = 2021
       UNION ALL SELECT 'unpaired quotes', count(*) + 1 FROM raw WHERE "YEAR" > 2022""",
)
def s4_refused(t):
    """Lines of refused files by reason."""
    folder, lines = new_folder(t.spark, "refused"), t.raw("YEAR", "US$ FOB", "PAIS DE DESTINO", "PRODUCTO")
    for name, part in (
        ("a", lines.where("YEAR <= 2020").drop("US$ FOB")),
        ("b", lines.where("YEAR = 2021").select("YEAR", "PRODUCTO")),
        ("c", lines.where("YEAR = 2022")),
    ):
        tables.write_csv(part, f"{folder}/{name}")
    last = lines.where("YEAR > 2022").select(F.concat_ws(",", "YEAR", C.named("US$ FOB"), C.named("PAIS DE DESTINO")).alias("value"))
    opened = t.spark.createDataFrame([('2023,"1,x',)], "value string")
    write_lines(opened.union(last), f"{folder}/d", "YEAR,US$ FOB,PAIS DE DESTINO")
    listed, found = export_files.landed_files(t.spark, folder), export_files.inspect_files(t.spark, folder)
    refused = export_files.refused_files(listed, found).join(found.select("file", "lines"), "file")
    return refused.groupBy("reason").agg(F.sum(F.col("lines") - 1).alias("records"))


_warehouses: dict = {}


def two_runs(t) -> str:
    """A warehouse after two runs of the job: lines to 2020 first; then the same files
    are still there, with a copy of one of them, the later lines, and files without FOB.
    Made once per session, as several queries read what the job leaves; the landed files
    are removed then."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _warehouses:
        warehouse = new_folder(t.spark, "warehouse")
        with scratch(t.spark):
            folder = new_folder(t.spark, "landing")
            with scratch(t.spark):
                # Three folders are written of the lines, which are joined once.
                lines = tables.stored(t.raw(*COLUMNS), "lines")
                tables.write_csv(lines.where("YEAR <= 2020"), f"{folder}/early")
                job.run(t.spark, folder, warehouse, RUN_AT)
                header = ",".join(COLUMNS)
                copied = t.spark.read.text(f"{folder}/early/part-00000-*.csv").where(F.col("value") != header)
                write_lines(copied, f"{folder}/copy", header)
                tables.write_csv(lines.where("YEAR > 2020").select(*[C.named(c) for c in reversed(COLUMNS)]), f"{folder}/late")
                tables.write_csv(lines.where("YEAR > 2020").drop("US$ FOB"), f"{folder}/without_fob")
            job.run(t.spark, folder, warehouse, LATER)
        _warehouses[key] = warehouse
    return _warehouses[key]


@query(
    "s15_incremental_load",
    """SELECT "NUMERO DE ACEPTACION", CAST("ITEM" AS VARCHAR) AS "ITEM", CAST("YEAR" AS VARCHAR) AS "YEAR",
         "US$ FOB", CASE WHEN "YEAR" <= 2020 THEN '20250115T060000' ELSE '20250116T060000' END AS load FROM raw""",
)
def s15_incremental(t):
    """Every line once, in the load that brought its file."""
    rows = job.current(t.spark, two_runs(t), "raw_exports")
    return rows.select("NUMERO DE ACEPTACION", "ITEM", "YEAR", C.named("US$ FOB"), F.col("LOAD").alias("load"))


@query(
    "s15_manifest",
    """SELECT '20250115T060000' AS load, 'loaded' AS status, count(*) AS records FROM raw WHERE "YEAR" <= 2020
       UNION ALL SELECT '20250116T060000', 'loaded', count(*) FROM raw WHERE "YEAR" > 2020
       UNION ALL SELECT '20250116T060000', 'refused', count(*) FROM raw WHERE "YEAR" > 2020
       UNION ALL SELECT '20250116T060000', 'repeated', 1 FROM region WHERE r_regionkey = 0""",
)
def s15_manifest(t):
    """Lines by load and status of their files, and the one file that was repeated."""
    rows = tables.read_table(t.spark, f"{two_runs(t)}/manifest")
    records = F.when(F.col("status") == "repeated", 1).otherwise(F.col("lines") - 1)
    return rows.groupBy(F.col("LOAD").alias("load"), "status").agg(F.sum(records).alias("records"))


@query(
    "dq_incremental_checks",
    f"""SELECT 'DQ1' AS check_id, CAST(count(*) AS DOUBLE) AS value FROM raw WHERE "YEAR" > 2020
        UNION ALL SELECT 'DQ2', count(*) FILTER ({number('"US$ FOB"')} IS NULL OR {number('"US$ FOB"')} < 0)
          * 100.0::DOUBLE / count(*) FROM raw WHERE "YEAR" > 2020
        UNION ALL SELECT 'DQ3', count(DISTINCT "PAIS DE DESTINO") FROM raw WHERE "YEAR" > 2020
        UNION ALL SELECT 'DQ9', 0 FROM region WHERE r_regionkey = 0""",
)
def incremental_checks(t):
    """The checks of the second run are about its own rows."""
    return tables.read_table(t.spark, f"{two_runs(t)}/export_checks").select("check_id", "value")


@query(
    "a7_observed_statistics",
    f"""SELECT '20250115T060000' AS load, count(*) AS records, {total('"FOB_CLEAN"')} AS total_fob_usd,
          '2025-01-15 06:00:00' AS last_extraction FROM clean WHERE "YEAR" <= 2020
        UNION ALL SELECT '20250116T060000', count(*), {total('"FOB_CLEAN"')}, '2025-01-16 06:00:00'
          FROM clean WHERE "YEAR" > 2020""",
)
def observed_statistics(t):
    """What the writes of the two loads have counted."""
    rows = tables.read_table(t.spark, f"{two_runs(t)}/load_statistics")
    at = F.date_format("last_extraction", "yyyy-MM-dd HH:mm:ss").alias("last_extraction")
    return rows.select(F.col("LOAD").alias("load"), F.col("clean_records").alias("records"), "total_fob_usd", at)


for _mart, _table in (("monthly", "monthly_exports_by_country"), ("regional", "regional_export_performance"),
                      ("product", "product_export_performance")):
    query(f"s16_{_mart}_of_loads", f"SELECT * FROM {_mart}")(
        lambda t, name=_table: tables.read_table(t.spark, f"{two_runs(t)}/{name}")
    )


@query("a28_analytics_of_loads", "SELECT * FROM export_analytics")
def analytics_of_loads(t):
    return tables.read_table(t.spark, f"{two_runs(t)}/export_analytics")


@query(
    "x1_streamed_load",
    """SELECT "NUMERO DE ACEPTACION", CAST("ITEM" AS VARCHAR) AS "ITEM", CAST("YEAR" AS VARCHAR) AS "YEAR",
         "US$ FOB" FROM raw""",
)
def x1_streamed(t):
    """Files of two layouts and encodings arrive in two runs of a stream; every batch is a
    load."""
    folder, warehouse = new_folder(t.spark, "landing"), new_folder(t.spark, "streamed")
    lines = t.raw("NUMERO DE ACEPTACION", "ITEM", "YEAR", "US$ FOB", "PAIS DE DESTINO")
    late = lines.where("YEAR > 2020").select(*[C.named(c) for c in reversed(lines.columns)])
    for name, part, encoding in (("early", lines.where("YEAR <= 2020"), "UTF-8"), ("late", late, "ISO-8859-1")):
        tables.write_csv(part, f"{folder}/{name}", encoding=encoding)
        loads.load_available(t.spark, folder, warehouse, f"{warehouse}/checkpoint", RUN_AT).awaitTermination()
    return job.current(t.spark, warehouse, "raw_exports").select(*[C.named(c) for c in lines.columns[:4]])


@query(
    "p19_clustered_destinations",
    """SELECT "YEAR", "PAIS_DESTINO_CLEAN", "FOB_CLEAN" FROM clean
       WHERE "PAIS_DESTINO_CLEAN" IN ('NATION C', 'NATION Q')""",
)
def p19_clustered(t):
    """Two destinations from the layout that the job writes, of which a small part is read."""
    rows = tables.clustered(t.clean("YEAR", "US$ FOB", "PAIS DE DESTINO"), "PAIS_DESTINO_CLEAN", "YEAR")
    path = tables.write_table(rows, new_folder(t.spark, "clustered"), by="YEAR", even=False)
    found = filter_in(tables.read_table(t.spark, path), "PAIS_DESTINO_CLEAN", ["NATION C", "NATION Q"])
    return found.select("YEAR", "PAIS_DESTINO_CLEAN", "FOB_CLEAN")
