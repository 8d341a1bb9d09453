"""The export job: new landed files to clean table, marts and checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..operators import marts, quality
from ..operators.exports import clean_exports, with_audit, with_date_numbers
from ..operators.totals import total
from ..session import scratch
from ..sources import folders, manifest
from ..sources.export_files import MALFORMED, landed_files, malformed_rows, read_files
from ..sources.tables import dealt_out, observed_write, read_table, replace_partitions, stored, write_table

# The marts, and the columns that a table must have for each. Every mart has a YEAR, so
# that a load changes only the years of its rows. The last two share a pre-aggregate.
MARTS = {
    "monthly_exports_by_country": (
        lambda lines, pre=None: marts.monthly_by_destination(lines),
        {"YEAR", "MES", "PAIS_DESTINO_CLEAN", "FOB_CLEAN", "PESO_BRUTO_CLEAN",
         "RUT PROBABLE EXPORTADOR"},
    ),
    "regional_export_performance": (
        marts.regional_by_year,
        {"YEAR", "REGION_ORIGEN_CLEAN", "FOB_CLEAN", "PAIS_DESTINO_CLEAN", "PRODUCTO_CLEAN"},
    ),
    "product_export_performance": (
        marts.product_by_year,
        {"YEAR", "PRODUCTO_CLEAN", "FOB_CLEAN", "FOB_PER_KG", "PAIS_DESTINO_CLEAN"},
    ),
}
STATISTICS = (
    "LOAD string, records bigint, invalid_fob bigint, beyond_limits bigint, destinations bigint, files bigint, "
    "first_extraction timestamp, last_extraction timestamp, clean_records bigint, total_fob_usd double"
)


def current(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """The rows of ``raw_exports`` or ``exports`` that count: those of finished loads."""
    known = manifest.read_manifest(spark, f"{warehouse}/manifest")
    return manifest.current_table(spark, f"{warehouse}/{name}", known)


def in_years(rows: DataFrame, years: list) -> DataFrame:
    """The rows of these years, None among them for rows without a year."""
    known = F.col("YEAR").isin([year for year in years if year is not None])
    return rows.where(known | F.col("YEAR").isNull() if None in years else known)


def build_marts(exports: DataFrame, warehouse: str, years: list | None = None) -> dict[str, bool]:
    """A1-A3, A28; tells which marts have rows. One whose columns are missing is left out.

    With ``years`` only these are computed and replaced; a year without rows any more
    goes from the mart.
    """
    with scratch(exports.sparkSession):
        return _build_marts(exports, warehouse, years)


def _build_marts(exports: DataFrame, warehouse: str, years: list | None) -> dict[str, bool]:
    spark = exports.sparkSession
    lines = exports if years is None else in_years(exports, years)
    possible = {name: columns <= set(exports.columns) for name, (_, columns) in MARTS.items()}
    pre = marts.pre_aggregate(lines) if any(possible.values()) else None
    written = {}
    for name, (mart, _) in MARTS.items():
        path = f"{warehouse}/{name}"
        if possible[name]:
            _replace_years(spark, mart(lines, pre), path, years)
        written[name] = possible[name] and folders.exists(spark, path)
    if all(written.values()):
        parts = [read_table(spark, f"{warehouse}/{name}") for name in written]
        if years is not None:
            parts = [in_years(part, years) for part in parts]
        _replace_years(spark, marts.export_analytics(*parts), f"{warehouse}/export_analytics", years, by="year")
    return written


def _replace_years(spark: SparkSession, rows: DataFrame, path: str, years: list | None, by: str = "YEAR") -> None:
    """Compute and write the rows once; what the write counts says which years are empty."""
    before = stored_years(spark, path, by) if folders.exists(spark, path) else set()
    seen = Observation()
    replace_partitions(rows.observe(seen, F.collect_set(by).alias("years"), F.count(F.lit(1)).alias("rows"), F.count(by).alias("dated")), path, by)
    left = {*seen.get["years"], *([None] if seen.get["rows"] > seen.get["dated"] else [])}
    for year in (before if years is None else before & set(years)) - left:
        folders.remove(spark, f"{path}/{by}={'__HIVE_DEFAULT_PARTITION__' if year is None else year}")
    if not left and not before - set(years or before):
        folders.remove(spark, path)


def stored_years(spark: SparkSession, path: str, by: str = "YEAR") -> set:
    """The partitions of a mart; a year is a folder, so no row is read for this."""
    return {row[0] for row in read_table(spark, path).select(by).distinct().collect()}


def run(spark: SparkSession, landing: str, warehouse: str, run_at: datetime) -> DataFrame:
    """The whole job over the files of a folder that are new; returns the checks of this
    load. A folder without any good file, and no earlier load, is an error."""
    load = manifest.load_id(run_at)
    earlier = manifest.read_manifest(spark, f"{warehouse}/manifest").where(F.col("LOAD") != load)
    fresh = manifest.changed_files(landed_files(spark, landing), earlier)
    checks = load_files(spark, fresh, warehouse, load, run_at)
    if manifest.read_manifest(spark, f"{warehouse}/manifest").where(F.col("status") == manifest.LOADED).isEmpty():
        raise ValueError(f"no file in {landing} has both a FOB and a destination column")
    return checks


def load_files(spark: SparkSession, fresh: DataFrame, warehouse: str, load: str, run_at: datetime) -> DataFrame:
    """One load of the given files (file, size, modified); returns its checks.

    The files are read once; their rows are added to the raw and the clean table as a
    load of their own, and only the marts of their years are computed anew. A file that
    comes again with other content takes the place of its earlier rows. What the write of
    the rows has counted makes up checks and statistics. The manifest comes last: a load
    that fails before it can be repeated, and a repeated load gives the same tables. What
    the steps leave for each other goes with them.
    """
    with scratch(spark):
        _load_files(spark, fresh, warehouse, load, run_at)
    return read_table(spark, f"{warehouse}/export_checks")


def _load_files(spark: SparkSession, fresh: DataFrame, warehouse: str, load: str, run_at: datetime) -> None:
    earlier = stored(manifest.read_manifest(spark, f"{warehouse}/manifest").where(F.col("LOAD") != load), "manifest")
    changes = manifest.inspect_changes(spark, fresh, earlier, load)
    files = changes.where(F.col("status") == manifest.LOADED)
    counts = {"records": 0, "invalid_fob": 0, "beyond_limits": 0, "destinations": 0, "files": 0}
    if not files.isEmpty():
        counts |= _load(spark, files, earlier.unionByName(manifest.entries(changes)), warehouse, load, run_at)
    manifest.commit(changes, f"{warehouse}/manifest", load)
    statistics = spark.createDataFrame([{"LOAD": load} | counts], STATISTICS)
    manifest.write_load(statistics, f"{warehouse}/load_statistics", load)
    write_table(quality.as_export_checks(statistics), f"{warehouse}/export_checks")


def clustered_clean(raw: DataFrame, by: str | None) -> DataFrame:
    """The clean lines, ``clustered`` as questions are asked: by destination in each year.

    The raw lines are dealt out, by what these keys will be, and cleaned where they arrive.
    They are narrower than clean ones, which no step then has to store or send.
    """
    lines = with_date_numbers(raw)
    year = [C.named(by)] if by is not None else []
    lines = dealt_out(lines, *year, C.destination_name(C.named("PAIS DE DESTINO")))
    return clean_exports(lines).sortWithinPartitions(*year, "PAIS_DESTINO_CLEAN")


def _load(spark, files: DataFrame, known: DataFrame, warehouse: str, load: str, run_at: datetime) -> dict:
    """Write the rows of new files and the marts of their years; returns what was counted."""
    own = {name: f"{warehouse}/{name}/LOAD={load}" for name in ("raw_exports", "exports", "malformed_records")}
    raw = read_files(spark, files, run_at, malformed=True)
    extracted = {"first_extraction": F.min("EXTRACTION_DATE"), "last_extraction": F.max("EXTRACTION_DATE")}
    counts = observed_write(raw, own["raw_exports"], **quality.export_measures(raw), **extracted)
    raw = read_table(spark, own["raw_exports"])
    names = raw.select(quality.known_destination().alias("name")).dropna().distinct()
    counts |= {"files": files.count(), "destinations": names.count()}
    write_table(malformed_rows(raw), own["malformed_records"])
    by = "YEAR" if "YEAR" in raw.columns else None
    clean = with_audit(clustered_clean(raw.drop(MALFORMED), by), run_at)
    measures = {"clean_records": F.count(F.lit(1)), "total_fob_usd": total(F.col("FOB_CLEAN"))}
    counts |= observed_write(clean, own["exports"], by=by, even=False, **measures)
    if by:
        years = {row.YEAR for row in read_table(spark, own["exports"]).select("YEAR").distinct().collect()}
        again = files.select(F.col("file").alias("SOURCE_PATH"))
        replaced = stored(manifest.superseded(known).join(again, "SOURCE_PATH"), "replaced")
        loads = [row.LOAD for row in replaced.select("LOAD").distinct().collect()]
        if loads:
            old = read_table(spark, f"{warehouse}/exports").where(F.col("LOAD").isin(loads))
            old = old.join(replaced, ["LOAD", "SOURCE_PATH"], "left_semi")
            years |= {row.YEAR for row in old.select("YEAR").distinct().collect()}
        exports = manifest.current_table(spark, f"{warehouse}/exports", known)
        build_marts(exports, warehouse, sorted(years, key=str))
    return counts
