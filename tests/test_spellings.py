"""The training table from lines summed up by spelling: the same rows, and the lines read once."""

import datetime

import pytest

from tradepanel.catalog.adapter import SCHEMAS, Tables
from tradepanel.operators import features


@pytest.fixture()
def odd(spark, tmp_path):
    """Missing and repeated keys, several spellings of a label, negative and missing amounts."""
    day = lambda year: datetime.datetime(year, 5, 6)
    rows = {
        "nation": [(i, f"N{i}") for i in range(6)],
        "customer": [(i, i % 6) for i in range(12)] + [(3, 4), (12, None), (None, 2)],
        "supplier": [(i, i) for i in range(17)] + [(2, 5), (17, None)],
        "part": [(0, "vino"), (1, " Vino "), (2, "uva"), (3, None), (4, ""), (1, "uva")],
        "orders": [(i, i % 13, day(1995 + i % 5)) for i in range(70)] + [(7, 3, day(1997)), (70, None, None), (71, 1, None)],
        "lineitem": [(i % 74, i % 6, i % 19, i % 7 + 1, 1.5, 1e10 + i * 1.25e9) for i in range(400)]
        + [(5, None, None, 1, None, None), (None, 1, 1, 2, 1.0, 5e9)] * 2,
    }
    for name, some in rows.items():
        spark.createDataFrame(some, SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return Tables(spark, str(tmp_path))


def test_the_training_table_is_that_of_all_lines(odd):
    wanted = features.short_features(odd.panel(), odd.yearly_lines())
    found = odd.short_features()
    assert found.columns == wanted.columns and wanted.count() >= 10
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_lines_are_read_once(odd, monkeypatch):
    read, names = Tables.read, []
    monkeypatch.setattr(Tables, "read", lambda self, name: names.append(name) or read(self, name))
    plan = odd.short_features()._jdf.queryExecution().executedPlan().toString()
    assert names.count("lineitem") == 1 and "lineitem.parquet" not in plan
