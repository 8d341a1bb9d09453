"""Periodic runs against all periods in plain Python."""

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tradepanel.llm import periodic_runs
from tradepanel.llm.queries import QUERIES, made_periodic


def slow_runs(words):
    """(start, length, period) by start and then period."""
    words, size, found = np.array(words), len(words), []
    for q in range(1, size // 4 + 1):
        same = np.concatenate([[False], words[q:] == words[:-q], [False]])
        edges = np.flatnonzero(np.diff(same.astype(int))).reshape(-1, 2)
        for first, after in edges.tolist():
            length = after - first + q
            if length < max(6, 4 * q):
                continue
            part = words[first : first + length]
            if not any((part[d:] == part[:-d]).all() for d in range(1, q)):
                found.append((first, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def slow_row(doc_id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = slow_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    exponent = best and 1000 * best[1] // best[2]
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(found), *(best or (None, None, None)), exponent, *digests)


def test_query_against_all_periods(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = sorted(map(tuple, QUERIES["op12_periodic_runs"](spark, sf_dir).collect()))
    wanted = sorted(slow_row(r.doc_id, r.text) for r in docs.collect())
    assert found == wanted
    assert sum(row[1] > 0 for row in found) > 5


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 12), st.integers(0, 60), st.booleans())
def test_runs_of_short_sequences(words, period, first, cut):
    for i in range(min(first + period, len(words)), len(words)):
        words[i] = words[i - period]
    if cut and words:
        words[len(words) // 2] = 9
    assert [tuple(r) for r in periodic_runs.runs(np.array(words, np.int64))] == slow_runs(words)


def test_runs_of_long_sequences():
    random = np.random.default_rng(2)
    for period in (1, 3, 8, 9, 50, 333):
        words = random.integers(0, 2000, 2500)
        words[100 : 100 + 5 * period] = np.tile(words[100 : 100 + period], 5)
        assert [tuple(r) for r in periodic_runs.runs(words)] == slow_runs(words)


def test_squares_have_their_smallest_period():
    words = [0, 1, 0, 1, 0, 1, 0, 1, 2, 2]
    assert sorted(periodic_runs.squares(words)) == [(3, 2), (4, 2), (5, 2), (6, 2), (7, 2), (9, 1)]


def test_nulls_long_texts_and_clashing_columns(spark):
    long = " ".join(f"w{i % 700}" for i in range(30_000))
    rows = [(1, "a a a a a a"), (1, "a a a a a a"), (2, None), (3, ""), (4, " \t\n"), (5, "a"), (6, long), (None, "b c b c b c b c x")]
    frame = spark.createDataFrame([(i, t, 0, "s") for i, t in rows], "doc_id bigint, text string, runs int, starts string")
    got = {(r.doc_id, r.text): r for r in periodic_runs.periodic_runs(frame).collect()}
    assert len(got) == len(set(rows))
    assert [tuple(x) for x in got[1, "a a a a a a"].runs] == [(0, 6, 1)]
    assert got[1, "a a a a a a"].collapsed == "a"
    assert [tuple(x) for x in got[6, long].runs] == [(0, 30_000, 700)]
    assert got[6, long].collapsed == " ".join(f"w{i}" for i in range(700))
    assert got[None, "b c b c b c b c x"].collapsed == "b c x"
    for blank in ((2, None), (3, ""), (4, " \t\n")):
        assert got[blank].runs == [] and got[blank].collapsed == ""
    assert periodic_runs.periodic_runs(frame.where("false")).count() == 0
    made = {r.doc_id: r.text for r in made_periodic(frame.select("doc_id", "text")).collect()}
    assert made[2] is None and made[3] == "" and made[None] == rows[-1][1]
