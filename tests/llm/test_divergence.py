"""Divergence of sources: small cases in plain Python, and slices of few terms."""

import re
from collections import Counter
from itertools import product

from tradepanel.llm import divergence
from tradepanel.llm.queries import QUERIES


def slow(rows):
    """rows: (text, lang, source)."""
    rows = [tuple(x or "" for x in row) for row in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(lower)), lang, s) for t, lang, s in rows]
    result = []
    for lang in {row[1] for row in found}:
        held, groups = Counter(), {}
        for words, _, source in (x for x in found if x[1] == lang):
            held.update(set(words))
            groups.setdefault(source, Counter()).update(words)
        kept = [t for t, n in held.items() if n >= 3]
        whole = Counter()
        for c in groups.values():
            whole.update({t: c[t] for t in kept})

        def prices(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p, q = {s: prices(c) for s, c in groups.items()}, prices(whole)
        for s in groups:
            parts = {"pair": [], "term": []}
            parts["pair"] = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in groups if o != s]
            parts["term"] = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items in parts.items():
                ranked = sorted(items, key=lambda x: (x[0], x[1].encode()))
                ranked = ranked if part == "pair" else ranked[:200]
                result += [(lang, s, part, item, -value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(result)


ROWS = [
    ("A a b, c9d É", "en", "x"), ("a b c d é", "en", "y"), ("a b e", "en", "z"), ("b b b e e", "en", "x"), ("e E", "en", None),
    ("a a a a", None, "x"), ("a", "", "y"), (None, "", "z"), ("a q", "", None), ("q q", None, None), ("", "de", "x"), (None, "de", "y"),
    ("one", "fr", "x"), ("one", "fr", "x"), ("one two", "fr", "x"),
]


def test_small_cases(spark):
    frame = spark.createDataFrame([(*row, 1, "t") for row in ROWS], "text string, lang string, source string, n int, term string")
    found = divergence.divergence(frame.repartition(4))
    assert found.dtypes[4:] == [("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, found.collect())) == slow(ROWS)
    assert divergence.divergence(frame.where("false")).count() == 0


def test_slices_of_few_terms_and_full_workers(spark, monkeypatch):
    rows = [(" ".join(f"t{chr(97 + i % 26)}{chr(97 + j)}" for j in range(k % 7)), "en", f"s{k % 3}") for i, k in product(range(8), range(21))]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    monkeypatch.setattr(divergence, "SLICE", 3)
    monkeypatch.setattr(divergence, "HELD_TERMS", 5)
    assert sorted(map(tuple, divergence.divergence(frame).collect())) == slow(rows)


def test_query_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = QUERIES["op13_divergence"](spark, sf_dir)
    assert sorted(map(tuple, found.collect())) == slow([(r.text, r.lang, r.source) for r in docs])


def test_prices_beyond_64_bits():
    import numpy as np

    counts = np.array([0, 5, 10**15])
    assert divergence._prices(counts, 10**15 + 7).tolist() == [1 + (n + 1) * 10**9 // (10**15 + 7) for n in counts.tolist()]
