"""The operators that are to run without Python on the executors."""

import pytest

from tradepanel.llm.queries import QUERIES


@pytest.mark.parametrize("name", ["op1_fingerprints", "op4_pii", "op7_line_dedup"])
def test_column_expressions_only(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in found
