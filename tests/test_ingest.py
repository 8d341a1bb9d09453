"""Files with mixed encodings, headers and layouts."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradepanel.operators import panel
from tradepanel.sources import export_files, files, gdp_files, tables

AT = datetime(2025, 1, 15, 6, 0, 0)


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "a.csv").write_bytes(
        "Año,US$ FOB,PAIS DE DESTINO,PRODUCTO,REGION DE ORIGEN\n"
        "2024,100.5,España,vino,Valparaíso\n"
        '2024,"1,200",Perú,"cobre ""fino"", ley 9",Biobío\n'.encode()
    )
    (tmp_path / "b.csv").write_bytes(
        "PAIS DE DESTINO,AÑO,PRODUCTO,US$ FOB\nMéxico,2023,\"uva\nroja\",50\n".encode("latin-1")
    )
    (tmp_path / "c.csv").write_bytes(
        b"\xef\xbb\xbf" + "US$ FOB,PAIS DE DESTINO,YEAR\n7,Japón,2022\n".encode()
    )
    (tmp_path / "no_fob.csv").write_text("PAIS DE DESTINO,PRODUCTO\nPeru,x\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "note.txt").write_text("US$ FOB,PAIS DE DESTINO\n1,x\n")
    return str(tmp_path)


def test_files_are_told_apart(spark, folder):
    found = {
        row.file.rsplit("/", 1)[1]: row
        for row in export_files.inspect_files(spark, folder).collect()
    }
    assert set(found) == {"a.csv", "b.csv", "c.csv", "no_fob.csv"}
    assert {n: r.encoding for n, r in found.items()} == {
        "a.csv": "UTF-8", "b.csv": "ISO-8859-1", "c.csv": "UTF-8", "no_fob.csv": "UTF-8"
    }
    assert [n for n, r in sorted(found.items()) if r.multi_line] == ["b.csv"]
    assert [n for n, r in sorted(found.items()) if r.valid] == ["a.csv", "b.csv", "c.csv"]
    assert [n for n, r in sorted(found.items()) if r.has_product] == ["a.csv", "b.csv", "no_fob.csv"]


def test_ingest_by_name_not_position(spark, folder):
    rows = {
        (row["YEAR"], row["US$ FOB"]): row for row in export_files.ingest(spark, folder, AT).collect()
    }
    assert set(rows) == {("2024", "100.5"), ("2024", "1,200"), ("2023", "50"), ("2022", "7")}
    assert rows["2024", "100.5"]["PAIS DE DESTINO"] == "España"
    assert rows["2024", "1,200"]["PRODUCTO"] == 'cobre "fino", ley 9'
    assert rows["2023", "50"]["PAIS DE DESTINO"] == "México"
    assert rows["2023", "50"]["PRODUCTO"] == "uva\nroja"
    assert rows["2022", "7"]["PRODUCTO"] is None
    assert rows["2022", "7"]["PAIS DE DESTINO"] == "Japón"
    assert rows["2023", "50"]["SOURCE_FILE"] == "b.csv"
    assert rows["2023", "50"]["EXTRACTION_DATE"] == AT


def test_ingest_needs_a_valid_file(spark, tmp_path):
    (tmp_path / "x.csv").write_text("A,B\n1,2\n")
    with pytest.raises(ValueError):
        export_files.ingest(spark, str(tmp_path), AT)


def test_header_is_the_first_line_of_a_file_in_many_splits(spark, tmp_path):
    lines = ["US$ FOB,PAIS DE DESTINO"] + [f"{i},country {i}" for i in range(50_000)]
    (tmp_path / "big.csv").write_text("\n".join(lines) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = export_files.inspect_files(spark, str(tmp_path)).first()
        assert found.header == lines[0] and found.valid
        assert export_files.ingest(spark, str(tmp_path), AT).count() == 50_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def record(code, year, value, name="Name"):
    return {
        "countryiso3code": code, "date": str(year), "value": value,
        "country": {"id": code[:2], "value": name},
        "indicator": {"id": "NY.GDP.MKTP.CD", "value": "GDP (current US$)"},
    }


def test_gdp_pages(spark, tmp_path):
    good = [{"page": 1}, [record("USA", 2023, 2.5e13), record("CHL", 2023, None),
                          record("", 2023, 5.0), record("PER", 2023, 10, name="")]]
    (tmp_path / "2023.json").write_text(json.dumps(good))
    (tmp_path / "2024.json").write_text(json.dumps([{"message": "no data"}]))
    assert gdp_files.read_records(spark, str(tmp_path)).count() == 4
    rows = gdp_files.read_gdp(spark, str(tmp_path)).collect()
    assert [(r.country_code, r.year, r.gdp_value, r.indicator_code) for r in rows] == [
        ("USA", 2023, 2.5e13, "NY.GDP.MKTP.CD")
    ]


def test_newest_fetch_of_a_year_counts(spark, tmp_path):
    fetches = [("b", 1_000, 1.0), ("a", 2_000, 2.0), ("c", 1_500, 3.0)]
    for name, time, value in fetches:
        page = tmp_path / f"{name}.json"
        page.write_text(json.dumps([{"page": 1}, [record("USA", 2023, value), record("CHL", 2023 + time, value)]]))
        os.utime(page, (time, time))
    rows = gdp_files.read_newest_gdp(spark, str(tmp_path))
    assert rows.columns == gdp_files.read_gdp(spark, str(tmp_path)).columns
    assert [r.gdp_value for r in rows.where("country_code = 'USA'").collect()] == [2.0]
    assert rows.where("country_code = 'CHL'").count() == 3


def test_years_stop_at_the_first_full_one(spark):
    years = [2024] * 2 + [2023] * 5 + [2022] * 9
    df = spark.createDataFrame([(y, i) for i, y in enumerate(years)], "year INT, n INT")
    kept = panel.years_until_enough(df, 4).select("year").distinct().collect()
    assert {r.year for r in kept} == {2024, 2023}
    assert panel.years_until_enough(df, 100).count() == len(years)
    assert panel.years_until_enough(df, 1).select("year").distinct().count() == 1


def test_pages_of_earlier_years_are_not_opened(spark, tmp_path):
    for year, codes in ((2021, 9), (2022, 5), (2023, 3), (2024, 1)):
        folder = tmp_path / "run_1999_x" / f"date={year}"
        folder.mkdir(parents=True)
        records = [record(f"C{i:02}", year, float(i + 1)) for i in range(codes)]
        (folder / "page.json").write_text(json.dumps([{"page": 1}, records]))
    (tmp_path / "page.json").write_text(json.dumps([{}, [record("XXX", 2000, 1.0)]]))
    (tmp_path / "run_1999_x" / "date=2021" / "page.json").write_text("[{}, [{not json")
    pages = gdp_files.pages_by_year(spark, str(tmp_path))
    assert {year: len(files) for year, files in pages.items()} == {None: 1, 2021: 1, 2022: 1, 2023: 1, 2024: 1}
    found = gdp_files.read_until_enough(spark, str(tmp_path), 4)
    assert {(r.year, r["count"]) for r in found.groupBy("year").count().collect()} == {(2024, 1), (2023, 3), (2022, 5), (2000, 1)}
    assert gdp_files.read_until_enough(spark, str(tmp_path), 0).where("year > 2000").count() == 1
    opened = spark.read.text(pages[2023]).inputFiles()
    assert all("date=2023" in file for file in opened)


def test_replacing_years_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("A", 2022, 1.0), ("A", 2023, 2.0)], "c STRING, year INT, v DOUBLE")
    new = spark.createDataFrame([("A", 2023, 3.0), ("B", 2024, 4.0)], "c STRING, year INT, v DOUBLE")
    tables.replace_partitions(old, path)
    for _ in range(2):
        tables.replace_partitions(new, path)
        found = {(r.c, r.year, r.v) for r in tables.read_table(spark, path).collect()}
        assert found == {("A", 2022, 1.0), ("A", 2023, 3.0), ("B", 2024, 4.0)}


def test_latest_file_and_artifact(spark, tmp_path):
    import os

    for name, time in (("monthly_1.csv", 100), ("monthly_2.csv", 300), ("regional.csv", 900),
                       ("metadata_20240101.json", 5), ("metadata_20250101.json", 1)):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (time, time))
    assert files.latest_file(spark, str(tmp_path), "monthly").first().path.endswith("monthly_2.csv")
    assert files.latest_file(spark, str(tmp_path)).first().path.endswith("regional.csv")
    found = files.latest_artifact(spark, str(tmp_path), "metadata").first().path
    assert found.endswith("metadata_20250101.json")


def test_csv_sink_keeps_text(spark, tmp_path):
    df = spark.createDataFrame([(" a ", 'say "x", y'), ("é", None)], "p STRING, q STRING")
    path = tables.write_csv(df, str(tmp_path / "out"), single_file=True)
    assert len(list((tmp_path / "out").glob("part-*.csv"))) == 1
    back = export_files.read_csv(spark, path, ["p", "q"])
    assert sorted(back.collect()) == sorted(df.collect())


def test_snapshots_are_kept(spark, tmp_path):
    path = str(tmp_path / "s")
    tables.write_snapshot(spark.range(2), path, AT)
    tables.write_snapshot(spark.range(3), path, datetime(2025, 2, 1))
    assert tables.read_table(spark, path).groupBy("snapshot_id").count().count() == 2
    with pytest.raises(Exception):
        tables.write_snapshot(spark.range(1), path, AT)


def test_row_guards(spark, tmp_path):
    assert tables.has_rows(spark.range(50), 50) and not tables.has_rows(spark.range(49), 50)
    assert not tables.has_rows(spark.range(0))
    with pytest.raises(ValueError):
        tables.require_rows(spark.range(49))
    assert not tables.write_if_any(spark.range(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    assert tables.write_if_any(spark.range(1), str(tmp_path / "one"))


def test_sql_scan(spark):
    found = tables.scan_sql(spark, "SELECT sum(id) AS s FROM {t}", t=spark.range(4)).first()
    assert found.s == 6


def test_provenance_of_files(spark, folder):
    df = export_files.ingest(spark, folder, AT)
    counts = {r.SOURCE_FILE: r["count"] for r in df.groupBy("SOURCE_FILE").count().collect()}
    assert counts == {"a.csv": 2, "b.csv": 1, "c.csv": 1}
    assert df.filter(F.col("EXTRACTION_DATE") != F.lit(AT)).isEmpty()


def test_job_leaves_out_marts_without_their_columns(spark, tmp_path):
    from tradepanel.plans import exports as job

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("US$ FOB,PAIS DE DESTINO,PRODUCTO\n5,Peru,x\n-1,Peru,y\n")
    warehouse = str(tmp_path / "warehouse")
    checks = {r.check_id: r.value for r in job.run(spark, str(tmp_path / "in"), warehouse, AT).collect()}
    assert (checks["DQ1"], checks["DQ2"], checks["DQ3"]) == (2, 50, 1)
    exports = tables.read_table(spark, f"{warehouse}/exports")
    assert [r.FOB_CLEAN for r in exports.collect()] == [5.0]
    assert not any(job.build_marts(exports, warehouse).values())


@pytest.mark.parametrize("name", ["Exp Enero 2024.csv", "exp[1].csv", "EXP.CSV", "100% {a} ñ+b.csv"])
def test_any_file_name_is_read(spark, tmp_path, name):
    (tmp_path / name).write_text("US$ FOB,PAIS DE DESTINO,YEAR\n7,Peru,2022\n")
    (row,) = export_files.ingest(spark, str(tmp_path), AT).collect()
    assert row["US$ FOB"] == "7"
