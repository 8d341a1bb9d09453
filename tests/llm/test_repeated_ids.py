"""Rows of one doc_id with different texts: no lost link, no lost line."""

from tradepanel.llm import line_dedup, near_dedup

A, B = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")


def test_sets_are_linked_whatever_their_ids(spark):
    rows = [(5, A), (5, B), (7, A), (8, A + " end"), (9, "something else"), (10, B + " end"), (None, A)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dedup.near_duplicates(frame).collect()}
    assert found[8, 57] == (5, False) and found[10, 57] == (5, False)
    assert found[7, 56] == (5, False) and found[None, 56] == (5, False)
    assert found[9, 1] == (9, True) and found[5, 56] == (5, True)
    for low in (1, 11):  # the other order of ids, and of set hashes
        rows = [(low, A), (low, B), (low + 2, A), (low + 3, A + " end"), (low + 4, B + " end")]
        frame = spark.createDataFrame(rows, "doc_id bigint, text string")
        assert {r.component_id for r in near_dedup.near_duplicates(frame).collect()} == {low}


def test_lines_go_from_the_text_that_holds_them(spark):
    rows = [(1, "copied line\nmine"), (2, "copied line\nfirst of two"), (2, "unique line\nsecond of two"), (2, "copied line\nfirst of two")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    cut = line_dedup.without_repeated_lines(frame)
    assert sorted(r.text for r in cut.collect()) == sorted(["copied line\nmine", "first of two", "unique line\nsecond of two", "first of two"])
    gone = line_dedup.repeated_lines(frame).collect()
    assert [(r.doc_id, r.line_no, r.keeper_doc_id) for r in gone] == [(2, 0, 1)]


def test_near_lines_of_two_texts_of_one_id(spark):
    words = [f"w{i}" for i in range(12)]
    near = " ".join(words[:4] + ["other"] + words[5:])
    frame = spark.createDataFrame([(3, " ".join(words)), (3, near), (4, "x")], "doc_id bigint, text string")
    (row,) = line_dedup.repeated_lines(frame).collect()
    assert (row.doc_id, row.line_no, row.keeper_doc_id, row.edits) == (3, 0, 3, 1)
    assert sum(r.text == "" for r in line_dedup.without_repeated_lines(frame).collect()) == 1
