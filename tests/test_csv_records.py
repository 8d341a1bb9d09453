"""CSV files with quoted line breaks, malformed records and refused files."""

import csv
import io
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradepanel.sources import csv_records, export_files

AT = datetime(2025, 1, 15, 6, 0, 0)
HEADER = "US$ FOB,PAIS DE DESTINO,PRODUCTO"


@pytest.fixture()
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]
    for name in names:
        spark.conf.set(name, "4k")
    yield
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def written(rows, header=HEADER):
    out = io.StringIO()
    out.write(header + "\n")
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue()


def some_rows(number, seed):
    """Fields with breaks, doubled quotes, commas, blank lines inside, and long ones."""
    make, pieces = random.Random(seed), ["a", 'say ""', "x,y", "\n", '"', " ", "é", "\n\n", "word " * 40]
    return [[str(i), f"country {i}", "".join(make.choice(pieces) for _ in range(make.randrange(1, 8))) + "."] for i in range(number)]


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_a_file_of_many_splits_is_read_by_many_tasks(spark, tmp_path, small_splits, encoding):
    rows = some_rows(3000, 1) + [["3000", "last", "over\n" * 4000 + "end"], ["3001", "after", "x"]]
    (tmp_path / "a.csv").write_bytes(written(rows).encode(encoding))
    (tmp_path / "b.csv").write_bytes(written(some_rows(50, 2)).encode(encoding))
    assert csv_records.byte_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 50
    found = export_files.ingest(spark, str(tmp_path), AT)
    assert "MultiLine" not in found._jdf.queryExecution().toString()
    got = sorted((r["SOURCE_FILE"], r["US$ FOB"], r["PAIS DE DESTINO"], r["PRODUCTO"]) for r in found.collect())
    assert got == sorted([("a.csv", *r) for r in rows] + [("b.csv", *r) for r in some_rows(50, 2)])


def test_equal_to_the_unsplit_reader(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text(written(some_rows(800, 3)))
    columns = HEADER.split(",")
    split = export_files.read_csv(spark, str(tmp_path), columns).select(*[F.col(f"`{c}`") for c in columns])
    reader = spark.read.schema(export_files.all_text(columns)).options(header=True, multiLine=True, escape='"')
    assert sorted(split.collect()) == sorted(reader.csv(str(tmp_path)).collect())


def test_malformed_records_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f'{HEADER}\n1,x,y\n2,x\n3,"x,z",y,"b,c",d\n4,x,y,\n')
    (tmp_path / "b.csv").write_text(f'{HEADER}\n5,"x\nx",y\n6,"x\nx",y,z\n7\n')
    (tmp_path / "c.csv").write_text(f"{HEADER},DIA\n8,x,y,1\n")
    found = export_files.ingest(spark, str(tmp_path), AT, malformed=True)
    bad = {r["US$ FOB"]: r[export_files.MALFORMED] for r in found.collect()}
    assert {k: (v.fields, v.expected) for k, v in bad.items() if v} == {
        "2": (2, 3), "3": (5, 3), "4": (4, 3), "6": (4, 3), "7": (1, 3)
    }
    assert bad["6"].record == '6,"x\nx",y,z'
    counts = {r.file.rsplit("/", 1)[1]: (r.surplus, r.short) for r in export_files.malformed_rows(found).collect()}
    assert counts == {"a.csv": (2, 1), "b.csv": (1, 1)}
    assert export_files.MALFORMED not in export_files.ingest(spark, str(tmp_path), AT).columns


def test_refused_files_have_reasons(spark, tmp_path):
    files = {
        "good.csv": f"{HEADER}\n1,x,y\n",
        "quoted.csv": '"US$ FOB, total","PAIS DE DESTINO"\n1,x\n',
        "split_words.csv": '"US$, FOB","PAIS, DESTINO"\n1,x\n',
        "no_fob.csv": "PAIS DE DESTINO\nx\n",
        "neither.csv": "A,B\n1,2\n",
        "open.csv": f'{HEADER}\n1,"x,y\n2,x,y\n',
        "tall.csv": '"US$\nFOB","PAIS DE DESTINO"\n1,x\n',
    }
    for name, content in files.items():
        (tmp_path / name).write_text(content)
    listed = export_files.landed_files(spark, str(tmp_path))
    inspected = export_files.inspect_files(spark, str(tmp_path))
    refused = {r.file.rsplit("/", 1)[1]: r.reason for r in export_files.refused_files(listed, inspected).collect()}
    assert refused == {
        "no_fob.csv": "no FOB column", "neither.csv": "no FOB column, no destination column",
        "open.csv": "unpaired quotes", "tall.csv": "no FOB column, no destination column, header spans lines",
    }
    assert {r["SOURCE_FILE"] for r in export_files.ingest(spark, str(tmp_path), AT).collect()} == set(files) - set(refused)


def test_records_cross_the_blocks_of_a_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_records, "BLOCK_BITS", 2)
    rows = some_rows(300, 5) + [["300", "last", "over\n" * 40 + "end"], ["301", "after", "x"]]
    (tmp_path / "a.csv").write_text(written(rows))
    found = export_files.ingest(spark, str(tmp_path), AT)
    assert sorted((r["US$ FOB"], r["PAIS DE DESTINO"], r["PRODUCTO"]) for r in found.collect()) == sorted(map(tuple, rows))
