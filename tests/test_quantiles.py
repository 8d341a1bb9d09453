"""Exact quantiles by counting, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradepanel.operators import quantiles as Q

NAMES = {"low": 0.0, "tenth": 0.1, "middle": 0.5, "high": 0.9, "top": 1.0}


def expected(values):
    return [float(np.quantile(values, f)) for f in NAMES.values()]


def found(row):
    return [getattr(row, name) for name in NAMES]


def test_one_hot_group_ties_and_wide_spreads(spark):
    random = np.random.default_rng(1)
    groups = {
        "hot": random.normal(0, 1e6, 20_000),
        "ties": random.integers(0, 3, 500).astype(float),
        "wide": np.concatenate([10.0 ** random.uniform(-300, 300, 400), -(10.0 ** random.uniform(-300, 300, 301))]),
        "close": 1 + np.arange(900) * np.finfo(float).eps,
        "single": np.array([7.0]),
        "pair": np.array([-0.0, 5.0]),
        None: np.arange(101.0),
    }
    rows = [(k, float(v)) for k, values in groups.items() for v in values]
    rows += [("hot", None), ("hot", float("nan")), ("none", None)]
    frame = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {r.k: r for r in Q.quantiles(frame, ["k"], "v", NAMES).collect()}
    assert set(got) == {*groups, "none"}
    assert found(got["none"]) == [None] * 5 and got["none"]["values"] == 0
    for key, values in groups.items():
        assert got[key]["values"] == len(values)
        assert found(got[key]) == pytest.approx(expected(values), rel=1e-12, abs=1e-300), key


def test_without_keys_and_empty(spark):
    frame = spark.range(1001).select((F.col("id") * 3).cast("double").alias("v"))
    (row,) = Q.quantiles(frame, [], "v", NAMES).collect()
    assert found(row) == [0, 300, 1500, 2700, 3000]
    (row,) = Q.quantiles(frame.where("false"), [], "v", NAMES).collect()
    assert found(row) == [None] * 5
    assert Q.quantiles(frame.where("false").withColumn("k", F.lit(1)), ["k"], "v", NAMES).count() == 0


def test_infinities(spark):
    values = [float("-inf"), -1.0, 0.0, 1.0, 2.0, 3.0, float("inf")]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    (row,) = Q.quantiles(frame, [], "v", {"low": 0.0, "middle": 0.5, "top": 1.0}).collect()
    assert (row.low, row.middle, row.top) == (values[0], 1.0, values[-1])


def test_nothing_is_gathered_by_group(spark):
    frame = spark.range(5000).select((F.col("id") % 2).alias("k"), F.rand(1).alias("v"))
    plan = Q.quantiles(frame, ["k"], "v", NAMES)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
