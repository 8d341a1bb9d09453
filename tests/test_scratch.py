"""What the export job leaves on disk: its tables, and nothing that its steps made for each other."""

import os
from datetime import datetime
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tradepanel import session
from tradepanel.catalog import loads as catalog
from tradepanel.catalog.adapter import Tables
from tradepanel.operators.exports import clean_exports
from tradepanel.plans import exports as job
from tradepanel.sources import tables

HEADER = "YEAR,MES,US$ FOB,PAIS DE DESTINO,PRODUCTO,REGION DE ORIGEN,PESO BRUTO,RUT PROBABLE EXPORTADOR\n"


def kept(spark):
    return set(os.listdir(urlparse(session.workspace(spark)).path))


def shuffle_files(spark):
    """The shuffle files of this session; kept alive by plans until these are collected."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name for top in folders for _, _, names in os.walk(top) for name in names if name.startswith("shuffle_")}


def land(landing, name, years, lines=40):
    rows = [f"{years[i % len(years)]},3,{i + 1},{'Perú' if i % 3 else 'Chile'},vino {i},Maule,2,{i}\n" for i in range(lines)]
    (landing / name).write_text(HEADER + "".join(rows))


def test_a_job_leaves_no_folder_and_no_shuffle_file(spark, tmp_path):
    landing, warehouse = tmp_path / "in", str(tmp_path / "warehouse")
    landing.mkdir()
    for day, years in ((1, (2020, 2021)), (2, (2021, 2022))):
        land(landing, f"{day}.csv", years)
        folders, files = kept(spark), shuffle_files(spark)
        checks = job.run(spark, str(landing), warehouse, datetime(2025, 1, day))
        assert kept(spark) == folders
        # The question whether any file was loaded is asked when the load has ended.
        written = shuffle_files(spark) - files
        assert len({name.split("_")[1] for name in written}) <= 1
        assert {r.check_id: r.value for r in checks.collect()}["DQ1"] == 40
    assert job.current(spark, warehouse, "exports").count() == 80
    assert tables.read_table(spark, f"{warehouse}/product_export_performance").agg(F.sum("EXPORT_COUNT")).first()[0] == 80


def test_scratch_goes_with_its_steps_and_an_outer_one_stays(spark):
    before = spark.conf.get(session.SHUFFLE_CLEANUP, None)
    outside = tables.stored(spark.range(3), "outside")
    with session.scratch(spark):
        outer = tables.stored(spark.range(4), "outer")
        with pytest.raises(ValueError, match="lost"), session.scratch(spark):
            tables.stored(spark.range(5), "inner")
            raise ValueError("lost")
        assert spark.conf.get(session.SHUFFLE_CLEANUP) == "true"
        assert outer.count() == 4 and not [name for name in kept(spark) if name.startswith("inner-")]
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == before
    assert outside.count() == 3 and not [name for name in kept(spark) if name.startswith("outer-")]


def test_a_frame_that_is_asked_again_within_scratch(spark):
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with session.scratch(spark):
        assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, counts.collect()))
        assert counts.count() == counts.count() == 7
    assert counts.count() == 7


@pytest.mark.parametrize("by", ["YEAR", None])
def test_lines_cleaned_where_they_arrive(spark, tmp_path, by):
    """The same rows as cleaned first, in order of year and destination; a destination
    with most of the lines, and lines without one, are spread."""
    number = F.col("id")
    raw = spark.range(0, 60_000, 1, 4).select(
        (number % 2 + 2022).cast("string").alias("YEAR"),
        F.when(number % 11 == 0, "x").otherwise(F.concat(F.lit("US$ "), (number - 7).cast("string"))).alias("US$ FOB"),
        F.when(number % 5 == 0, F.lit(None)).when(number % 5 > 1, " Perú.").otherwise(F.concat(F.lit("land "), F.char((number % 26 + 65).cast("int")))).alias("PAIS DE DESTINO"),
        number.cast("string").alias("ITEM"),
    )
    raw = raw if by else raw.drop("YEAR")
    found = job.clustered_clean(raw, by)
    assert found.exceptAll(clean_exports(raw)).isEmpty() and clean_exports(raw).exceptAll(found).isEmpty()
    # Whether Spark merges small ranges afterwards depends on the sample they are made from.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = tables.write_table(found, str(tmp_path / "t"), by=by, even=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in files) < 20_000
    for file in files:
        names = [r[0] for r in spark.read.parquet(file[0]).select("PAIS_DESTINO_CLEAN").collect()]
        assert names == sorted(names, key=lambda name: (name is not None, name))


def test_two_runs_join_the_lines_once_and_leave_the_warehouse(spark, sf_dir, monkeypatch):
    joined = []

    class Counted(Tables):
        def raw(self, *columns):
            joined.append(columns)
            return super().raw(*columns).limit(200)

    written, stored = [], tables.stored
    monkeypatch.setattr(tables, "stored", lambda df, name: written.append(name) or stored(df, name))
    monkeypatch.setattr(catalog, "_warehouses", {})
    before = kept(spark)
    warehouse = catalog.two_runs(Counted(spark, sf_dir))
    assert len(joined) == 1 and written.count("lines") == 1
    left = kept(spark) - before
    assert left == {warehouse.rsplit("/", 1)[1]} and warehouse.rsplit("/", 1)[1].startswith("warehouse-")
    status = {r.status for r in tables.read_table(spark, f"{warehouse}/manifest").collect()}
    assert status == {"loaded", "repeated", "refused"}
