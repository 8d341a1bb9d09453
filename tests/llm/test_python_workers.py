"""Python functions run once a row, in one worker for each task."""

from pyspark.sql import functions as F

from tradepanel.llm import near_dedup

TEXTS = [(1, "one two three four five six"), (2, "one two three four five six seven"), (3, "one two three four five six"), (4, None)]


def python_nodes(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_sets_of_nodes_are_made_once(spark):
    rows = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    keys = {d: near_dedup.set_key(near_dedup.shingle_set(t)) for d, t in TEXTS}
    wanted = spark.createDataFrame([(11, 1, keys[1]), (12, 2, keys[2])], "node bigint, doc_id bigint, set_key binary")
    sets = near_dedup._sets_of_nodes(rows, wanted)
    assert python_nodes(sets) == 1
    found = {r.node: (sorted(r.shingles), list(r.parity)) for r in sets.collect()}
    assert found == {
        node: (sorted(s.view("int64").tolist()), near_dedup.set_parity(s).tolist())
        for node, s in ((11, near_dedup.shingle_set(TEXTS[0][1])), (12, near_dedup.shingle_set(TEXTS[1][1])))
    }


def test_signatures_joined_by_their_key_are_made_once(spark):
    rows = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    keys = rows.select("doc_id", near_dedup.signature(F.col("text"))["set_key"].alias("set_key"))
    one = spark.createDataFrame([(near_dedup.set_key(near_dedup.shingle_set(TEXTS[0][1])),)], "set_key binary")
    joined = keys.join(one, "set_key")
    assert python_nodes(joined) == 1
    assert sorted(r.doc_id for r in joined.collect()) == [1, 3]
