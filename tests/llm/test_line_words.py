"""Words of a line: found once, in compiled code, and equal to those of plain Python."""

import re

from pyspark.sql import functions as F

from tradepanel.llm import line_dedup

TEXTS = [
    "  One\ttwo \x0b three  \nONE TWO THREE\n\n \t \none two three four",
    "a b c d e f g h\r\na  b c d e f g h \nÀ É b c d e f g h i\n" + "x " * 40,
    "", "\n\n", "w1 w2 w3 w4 w5 w6 w7\nÀ é b c D e f g h i",
]


def lines_of(spark, min_words=8, equal_words=1):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").withColumn("text_hash", F.xxhash64("text"))
    return line_dedup._lines(rows, min_words, equal_words)


def test_words_are_found_once_and_compiled(spark):
    plan = lines_of(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("regexp_replace(") == 1


def test_lines_meet_by_their_words(spark):
    wanted = {}
    for doc, text in enumerate(TEXTS):
        for number, line in enumerate(text.split("\n")):
            if words := tuple(w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w):
                wanted[doc, number] = words
    found = {(r.doc_id, r.line_no): r for r in lines_of(spark).collect()}
    assert found.keys() == wanted.keys()
    for a, r in found.items():
        assert (r.halves is not None) == (len(wanted[a]) >= 8)
        assert {b for b, s in found.items() if (s.h, s.g) == (r.h, r.g)} == {b for b in wanted if wanted[b] == wanted[a]}
    assert {(r.doc_id, r.line_no) for r in lines_of(spark, 8, 4).collect()} == {a for a, w in wanted.items() if len(w) >= 4}
    assert {(r.doc_id, r.line_no) for r in lines_of(spark, 2, 9).collect()} == {a for a, w in wanted.items() if len(w) >= 2}
