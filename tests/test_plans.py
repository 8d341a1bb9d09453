"""Physical plans: what is read, what is shuffled, and what must not occur."""

import re

import pytest

from tradepanel.catalog import QUERIES

UNWANTED = (
    "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
    "FlatMapGroupsInPandas", "MapInPandas",
)
# Queries whose only work is reading back files or models they have just written.
WRITTEN = re.compile(r"^(s\d|x1|m\d|o4|m_)")
PLANNED = sorted(name for name in QUERIES if not WRITTEN.match(name))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimised(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_unwanted_operator(spark, sf_dir, name):
    found = plan(QUERIES[name](spark, sf_dir))
    assert not [word for word in UNWANTED if word in found]


def scan_of(found: str, table: str) -> str:
    return next(line for line in found.splitlines() if "FileScan" in line and f"{table}.parquet" in line)


def test_scan_reads_only_the_needed_columns(tables):
    found = plan(tables.clean("YEAR", "US$ FOB"))
    scan = scan_of(found, "lineitem")
    assert "l_orderkey" in scan and "l_extendedprice" in scan
    assert "l_partkey" not in scan and "l_quantity" not in scan
    assert "part.parquet" not in found and "customer.parquet" not in found


def test_monthly_mart_joins_no_unused_table(tables):
    found = plan(tables.monthly())
    assert "customer.parquet" in found
    assert "part.parquet" not in found and "supplier.parquet" not in found


def test_sums_are_partial_before_the_shuffle(tables):
    found = plan(tables.monthly())
    assert "partial_sum" in found and "partial_count" in found


@pytest.mark.parametrize(
    "name",
    ["a2_regional_by_year", "a3_product_by_year", "a4_yearly_features", "a5_yearly_averages",
     "a7_run_statistics", "a12_export_data_summary"],
)
def test_several_distinct_counts_without_expand(spark, sf_dir, name):
    found = plan(QUERIES[name](spark, sf_dir))
    assert "Expand" not in found
    assert found.count("Exchange ") == 2


def exchanges_and_windows(df) -> tuple[int, int]:
    """Of the plan that has run, those that are reused left out."""
    df.collect()
    found = plan(df).split("== Initial Plan ==")[0]
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange [a-zA-Z]", found)), len(re.findall(r"\bWindow \[", found))


def test_long_features_have_few_exchanges_and_windows(spark, sf_dir):
    exchanges, windows = exchanges_and_windows(QUERIES["m16_long_features"](spark, sf_dir))
    assert exchanges <= 8 and windows <= 5


def test_average_ranks_come_from_one_window(panel):
    from tradepanel.operators import features

    ranked = panel.select("country_code", "year", features.average_rank_share("gdp_value"))
    found = plan(ranked)
    assert found.count("Window [") == 1 and found.count("Exchange ") == 1


def test_year_filter_prunes_partitions(spark, tables, tmp_path):
    from tradepanel.operators.exports import filter_in
    from tradepanel.operators.reports import export_trend
    from tradepanel.sources.tables import read_table, write_table

    path = write_table(tables.clean("YEAR", "MES", "US$ FOB"), str(tmp_path / "t"), by="YEAR")
    found = plan(export_trend(read_table(spark, path), [2020]))
    scan = next(line for line in found.splitlines() if "FileScan" in line)
    assert re.search(r"PartitionFilters: \[[^]]*YEAR[^]]* = 2020", scan)
    assert "ReadSchema: struct<FOB_CLEAN:double>" in scan
    pushed = plan(filter_in(read_table(spark, path), "MES", [3, 4]))
    assert "PushedFilters: [In(MES, [3,4])]" in pushed


def test_windows_of_the_training_table_share_exchanges(tables, panel):
    from tradepanel.operators import features

    wide = panel.select(
        "country_code", "year", features.before("gdp_value"), features.moving_average("gdp_value"),
        features.moving_deviation("gdp_growth_rate"), features.change("ranking"),
    )
    assert plan(wide).count("Exchange hashpartitioning(country_code") == 1


def test_long_code_lists_are_sets(panel):
    from pyspark.sql import functions as F

    from tradepanel.functions import gdp

    assert "INSET" in optimised(panel.filter(gdp.is_country(F.col("country_code"))))


def test_one_pass_for_all_export_checks(tables):
    from tradepanel.operators import quality

    found = plan(quality.export_checks(tables.raw("US$ FOB", "PAIS DE DESTINO")))
    assert found.count("lineitem.parquet") == 1


def test_one_pass_for_all_panel_checks(panel):
    from tradepanel.operators import quality

    assert plan(quality.panel_checks(panel)).count("FileScan") == 1
