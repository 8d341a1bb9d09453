"""The export job run again and again over a folder that grows."""

import os
from datetime import datetime

import pytest

from tradepanel.plans import exports as job
from tradepanel.plans.dashboard import Dashboard
from tradepanel.sources import export_files, folders, manifest, tables
from tradepanel.streaming import loads

HEADER = "YEAR,MES,US$ FOB,PAIS DE DESTINO,PRODUCTO,REGION DE ORIGEN,PESO BRUTO,RUT PROBABLE EXPORTADOR\n"


def at(day):
    return datetime(2025, 1, day, 6, 0, 0)


def line(year, fob, country="Peru"):
    return f"{year},3,{fob},{country},vino,Maule,2,77\n"


@pytest.fixture()
def places(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in", str(tmp_path / "warehouse")


def checks(spark, places, day):
    landing, warehouse = places
    return {r.check_id: r.value for r in job.run(spark, str(landing), warehouse, at(day)).collect()}


def amounts(spark, warehouse, name="exports"):
    return sorted(r.FOB_CLEAN for r in job.current(spark, warehouse, name).collect())


def same_marts(spark, warehouse):
    """The stored marts are those of all lines together."""
    exports = job.current(spark, warehouse, "exports")
    for name, (mart, _) in job.MARTS.items():
        wanted = mart(exports)
        found = tables.read_table(spark, f"{warehouse}/{name}").select(wanted.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect())), name
    facts = tables.read_table(spark, f"{warehouse}/export_analytics").count()
    assert facts == sum(mart(exports).count() for mart, _ in job.MARTS.values())


def test_new_repeated_changed_and_refused_files(spark, places):
    landing, warehouse = places
    (landing / "a.csv").write_text(HEADER + line(2023, 1) + line(2023, 2))
    (landing / "bad.csv").write_text("X\n1\n")
    assert checks(spark, places, 1)["DQ1"] == 2
    assert amounts(spark, warehouse) == [1, 2]

    # a new file, a copy of an old one, and a malformed record
    (landing / "b.csv").write_text(HEADER + line(2024, 3) + line(2024, -1) + "2024,3\n")
    (landing / "copy.csv").write_text(HEADER + line(2023, 2) + line(2023, 1))
    found = checks(spark, places, 2)
    assert (found["DQ1"], round(found["DQ2"], 3)) == (3, 66.667)
    assert amounts(spark, warehouse) == [1, 2, 3]
    same_marts(spark, warehouse)

    # nothing new: nothing is read, and no check of rows can pass
    found = checks(spark, places, 3)
    assert found["DQ1"] == 0 and amounts(spark, warehouse) == [1, 2, 3]

    # other content under an old name; 2023 loses all of its rows
    (landing / "a.csv").write_text(HEADER + line(2022, 5) + line(2022, 6, "Chile") + line(2022, 7))
    assert checks(spark, places, 4)["DQ1"] == 3
    assert amounts(spark, warehouse) == [3, 5, 6, 7]
    same_marts(spark, warehouse)
    years = {r.YEAR for r in tables.read_table(spark, f"{warehouse}/regional_export_performance").collect()}
    assert years == {2022, 2024}

    board = Dashboard(spark, warehouse)
    assert [(os.path.basename(r.file), r.reason) for r in board.get_refused_files().collect()] == [
        ("bad.csv", "no FOB column, no destination column")
    ]
    assert [(r.surplus, r.short) for r in board.get_malformed_records().collect()] == [(0, 1)]
    assert [r.records for r in board.get_load_statistics().collect()] == [2, 3, 0, 3]
    status = {(r.LOAD[:8], os.path.basename(r.file)): r.status for r in board._table("manifest").collect()}
    assert status["20250102", "copy.csv"] == "repeated" and status["20250104", "a.csv"] == "loaded"


def test_a_repeated_run_and_a_failed_one(spark, places, monkeypatch):
    landing, warehouse = places
    (landing / "a.csv").write_text(HEADER + line(2023, 1))
    checks(spark, places, 1)
    (landing / "b.csv").write_text(HEADER + line(2024, 2) + line("", 3))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(manifest, "commit", fail)
        with pytest.raises(RuntimeError):
            checks(spark, places, 2)
    assert amounts(spark, warehouse) == [1]  # rows of a load that has not ended do not count
    for _ in range(2):
        assert checks(spark, places, 3)["DQ1"] == 2
        assert amounts(spark, warehouse) == [1, 2, 3]
        same_marts(spark, warehouse)
    assert folders.exists(spark, f"{warehouse}/raw_exports/LOAD=20250102T060000")


def test_only_changed_files_are_read(spark, places):
    landing, warehouse = places
    (landing / "a.csv").write_text(HEADER + line(2023, 1))
    checks(spark, places, 1)
    (landing / "b.csv").write_text(HEADER + line(2024, 2))
    known = manifest.read_manifest(spark, f"{warehouse}/manifest")
    fresh = manifest.changed_files(export_files.landed_files(spark, str(landing)), known)
    changes = manifest.inspect_changes(spark, fresh, known, "next")
    assert [os.path.basename(r.file) for r in changes.collect()] == ["b.csv"]


def test_an_empty_mart_leaves_what_was_there(spark, tmp_path):
    path = str(tmp_path / "mart")
    assert tables.write_if_any(spark.range(3), path)
    assert not tables.write_if_any(spark.range(0), path)
    assert tables.read_table(spark, path).count() == 3
    assert tables.write_if_any(spark.range(5), path) and tables.read_table(spark, path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["mart"]


def test_measures_are_observed_by_the_write(spark, tmp_path):
    from pyspark.sql import functions as F

    found = tables.observed_write(spark.range(10), str(tmp_path / "t"), rows=F.count(F.lit(1)), most=F.max("id"))
    assert found == {"rows": 10, "most": 9}


def stream(spark, places, day, files_per_batch=1):
    landing, warehouse = places
    running = loads.load_available(spark, str(landing), warehouse, f"{warehouse}/checkpoint", at(day), files_per_batch)
    running.awaitTermination()
    assert running.exception() is None


def test_a_stream_of_files_of_any_layout(spark, places):
    landing, warehouse = places
    (landing / "a.csv").write_text(HEADER + line(2023, 1))
    (landing / "b.csv").write_bytes("PAIS DE DESTINO,AÑO,PRODUCTO,US$ FOB\nMéxico,2023,\"uva\nroja\",2\n".encode("latin-1"))
    (landing / "bad.csv").write_text("X\n1\n")
    stream(spark, places, 1)
    assert amounts(spark, warehouse) == [1, 2]
    (landing / "c.csv").write_text(HEADER + line(2024, 3) + line(2023, 4))
    (landing / "copy.csv").write_text(HEADER + line(2023, 1))
    for _ in range(2):  # the second run meets no new file
        stream(spark, places, 2)
        rows = job.current(spark, warehouse, "exports").collect()
        assert sorted((r.FOB_CLEAN, r["PAIS_DESTINO_CLEAN"]) for r in rows) == [
            (1, "PERU"), (2, "MEXICO"), (3, "PERU"), (4, "PERU")
        ]
        same_marts(spark, warehouse)
    found = {(os.path.basename(r.file), r.status) for r in manifest.read_manifest(spark, f"{warehouse}/manifest").collect()}
    assert found == {("a.csv", "loaded"), ("b.csv", "loaded"), ("bad.csv", "refused"), ("c.csv", "loaded"), ("copy.csv", "repeated")}


def test_two_streamed_runs_equal_one(spark, places, tmp_path):
    landing, warehouse = places
    for number in range(4):
        (landing / f"{number}.csv").write_text(HEADER + line(2020 + number, number + 1))
        if number % 2:
            stream(spark, places, number + 1)
    stream(spark, (landing, str(tmp_path / "once")), 9, files_per_batch=100)
    assert amounts(spark, warehouse) == amounts(spark, str(tmp_path / "once")) == [1, 2, 3, 4]
    again = spark.createDataFrame([], "file string, size bigint, modified timestamp")
    job.load_files(spark, again, warehouse, "empty", at(9))  # a load without files changes no row
    assert amounts(spark, warehouse) == [1, 2, 3, 4]


def test_a_filter_by_destination_reads_a_small_part(spark, tmp_path):
    """Forty destinations, one with a third of all rows, in years of one file or more."""
    from pyspark.sql import functions as F

    number = F.col("id")
    country = F.when(number % 3 == 0, "PERU").otherwise(F.concat(F.lit("LAND "), (number % 40 + 10).cast("string")))
    rows = spark.range(0, 60_000, 1, 8).select(number, (number % 2 + 2023).alias("YEAR"), country.alias("COUNTRY"))
    path = tables.write_table(tables.clustered(rows, "COUNTRY", "YEAR"), str(tmp_path / "t"), by="YEAR", even=False)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in files) < 20_000  # the third of all rows is spread
    wanted = spark.read.parquet(path).where("COUNTRY = 'LAND 21' AND YEAR = 2024")
    assert wanted.count() == rows.where("COUNTRY = 'LAND 21' AND YEAR = 2024").count() > 0
    found = wanted.select("id")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [IsNotNull(COUNTRY), EqualTo(COUNTRY,LAND 21)]" in plan.toString()
    assert scanned(plan) < 60_000 / 6


def scanned(plan) -> int:
    """Rows that the scans of a plan that has run gave."""
    own = plan.metrics().get("numOutputRows").get().value() if "Scan" in plan.nodeName() else 0
    inner = [plan.children().apply(i) for i in range(plan.children().size())]
    if hasattr(plan, "executedPlan") and "Adaptive" in plan.nodeName():
        inner = [plan.executedPlan()]
    return own + sum(scanned(child) for child in inner)
