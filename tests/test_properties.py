"""Facts that must hold between results, and exactness under skew."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tradepanel.operators import marts
from tradepanel.operators import quality as Q
from tradepanel.operators.totals import mean, total
from tradepanel.sources.tables import seed_reference_regions


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_country_totals_from_mart_and_from_lines(exports):
    mart = marts.by_country_from_mart(marts.monthly_by_destination(exports))
    assert rows(mart) == rows(marts.by_country_from_lines(exports))


def test_regional_marts_add_up(exports):
    with_region = exports.filter(F.col("REGION_ORIGEN_CLEAN").isNotNull())
    wanted = with_region.agg(total(F.col("FOB_CLEAN")), F.count("*")).first()
    found = marts.regional_by_year(exports).agg(
        total(F.col("TOTAL_FOB_USD")), F.sum("TOTAL_EXPORTS")
    ).first()
    assert tuple(found) == tuple(wanted)


def test_result_does_not_depend_on_partitioning(exports):
    once = rows(marts.product_by_year(exports))
    for other in (exports.repartition(13), exports.coalesce(1), exports.orderBy(F.rand(1))):
        assert rows(marts.product_by_year(other)) == once


def test_one_destination_with_a_third_of_all_lines(spark):
    """Whole results for a hot key, against plain Python."""
    lines = [
        (2024, 1, "HOT" if i % 3 == 0 else f"C{i % 50}", i / 100, 1.0, f"E{i % 997}")
        for i in range(1, 30_001)
    ]
    df = spark.createDataFrame(
        lines,
        "YEAR INT, MES INT, PAIS_DESTINO_CLEAN STRING, FOB_CLEAN DOUBLE, PESO_BRUTO_CLEAN DOUBLE, "
        "`RUT PROBABLE EXPORTADOR` STRING",
    )
    hot = [line for line in lines if line[2] == "HOT"]
    found = marts.monthly_by_destination(df).filter("PAIS_DESTINO_CLEAN = 'HOT'").first()
    assert found.EXPORT_COUNT == len(hot)
    assert found.TOTAL_FOB_USD == sum(round(line[3] * 100) for line in hot) / 100
    assert found.UNIQUE_EXPORTERS == len({line[5] for line in hot})
    assert found.TOTAL_WEIGHT_KG == len(hot)


def test_missing_destination_is_its_own_group(spark):
    df = spark.createDataFrame(
        [(2024, 1, None, 5.0, None, None), (2024, 1, "A", 7.0, 1.0, "x")],
        "YEAR INT, MES INT, PAIS_DESTINO_CLEAN STRING, FOB_CLEAN DOUBLE, PESO_BRUTO_CLEAN DOUBLE, "
        "`RUT PROBABLE EXPORTADOR` STRING",
    )
    found = {r.PAIS_DESTINO_CLEAN: r for r in marts.monthly_by_destination(df).collect()}
    assert found[None].TOTAL_FOB_USD == 5 and found[None].UNIQUE_EXPORTERS == 0
    assert found[None].TOTAL_WEIGHT_KG == 0


def test_exact_totals(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "v DOUBLE")
    found = df.agg(total(F.col("v")), mean(F.col("v"))).first()
    assert found[0] == 0.6 and found[1] == pytest.approx(0.2)
    assert tuple(df.filter("v > 9").agg(total(F.col("v")), mean(F.col("v"))).first()) == (None, None)


def test_amounts_far_beyond_the_declared_limit_are_summed(spark):
    df = spark.createDataFrame([(1e20,), (1e20,)], "v DOUBLE")
    assert df.agg(total(F.col("v"))).first()[0] == 2e20
    more = spark.createDataFrame([(9e29,), (0.1,), (0.2,), (None,)], "v DOUBLE")
    assert more.agg(total(F.col("v"))).first()[0] == 9e29


def test_seeding_twice_adds_nothing(tables):
    facts = marts.export_analytics(tables.monthly(), tables.regional(), tables.product())
    once = seed_reference_regions(facts)
    assert once.count() == facts.count() + 10
    assert seed_reference_regions(once).count() == once.count()


def test_panel_has_no_duplicates(panel):
    checks = {r.check_id: r for r in Q.panel_checks(panel).collect()}
    assert checks["DQ8"].value == 0 and checks["DQ8"].passed
    doubled = {r.check_id: r for r in Q.panel_checks(panel.union(panel)).collect()}
    assert doubled["DQ8"].value == panel.count() and not doubled["DQ8"].passed
    assert Q.panel_issues(panel).isEmpty()
    issues = Q.panel_issues(panel.union(panel))
    assert issues.count() == 2 * panel.count()


def test_checks_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "`US$ FOB` STRING, `PAIS DE DESTINO` STRING")
    checks = {r.check_id: r for r in Q.export_checks(empty).collect()}
    assert not checks["DQ1"].passed and not checks["DQ2"].passed and not checks["DQ3"].passed
    assert checks["DQ9"].passed
    nothing = spark.createDataFrame([], "country_code STRING, year INT, gdp_value DOUBLE, ranking INT")
    checks = {r.check_id: r.passed for r in Q.panel_checks(nothing).collect()}
    assert checks == {"DQ4": False, "DQ5": True, "DQ6": True, "DQ7": False, "DQ8": True}


def test_declared_limits(spark):
    df = spark.createDataFrame(
        [("x" * 101, "1", "5"), ("x" * 100, "99999999999999", None), (None, None, "3000000000")],
        "`PAIS DE DESTINO` STRING, `US$ FOB` STRING, `ITEM` STRING",
    )
    found = {r.column: r.violations for r in Q.limit_violations(df).collect()}
    assert found == {"PAIS DE DESTINO": 1, "US$ FOB": 1, "ITEM": 1}
    checks = {r.check_id: r.value for r in Q.export_checks(df).collect()}
    assert checks["DQ9"] == 3


def test_checks_since_a_day(spark):
    from datetime import datetime

    df = spark.createDataFrame(
        [("5", "A", datetime(2025, 1, 1)), ("-5", "B", datetime(2025, 1, 2)), ("", " ", datetime(2025, 1, 2))],
        "`US$ FOB` STRING, `PAIS DE DESTINO` STRING, EXTRACTION_DATE TIMESTAMP",
    )
    checks = {r.check_id: r.value for r in Q.export_checks(df, date(2025, 1, 2)).collect()}
    assert (checks["DQ1"], checks["DQ2"], checks["DQ3"]) == (2, 100, 1)
    assert Q.export_issues(df).count() == 2
    status = [r.status for r in Q.status_lines(Q.export_checks(df)).collect()]
    assert status[0] == "records loaded today: PASS (got 3.0, expected >= 1.0)"
