"""SimHash near-duplicates against all pairs in plain Python."""

import numpy as np
import pytest
import xxhash

from tradepanel.llm import simhash
from tradepanel.llm.queries import QUERIES


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashed = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def slow_components(rows):
    """rows: (doc_id, fingerprint); the smallest id reachable, for each row."""
    prints = np.array([f for _, f in rows], np.uint64)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= 4):
            label[root(i)] = root(int(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(doc_id, f"{f:016x}", least.get(root(i))) for i, (doc_id, f) in enumerate(rows)]


def compared(found, rows):
    wanted = slow_components([(i, slow_fingerprint(t)) for i, t in rows])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)


def test_query_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = QUERIES["op11_simhash"](spark, sf_dir)
    assert found.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    compared(found, [(r.doc_id, r.text) for r in docs.collect()])


def test_nulls_ties_and_clashing_columns(spark):
    long = " ".join(f"w{i % 999}" for i in range(70_000))
    rows = [(1, "a b c d e"), (2, "A  b\tC d e"), (2, "a b c d e"), (2, "other words"), (3, None), (4, ""), (5, " \n"), (6, "é")]
    rows += [(None, "a b c d e"), (None, "alone"), (7, long), (8, long + " end"), (9, "a b c d f")]
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id bigint, text string, fingerprint string, label int, anchor int")
    compared(simhash.near_duplicates(frame), rows)
    assert simhash.near_duplicates(frame.where("false")).count() == 0
    named = frame.selectExpr("concat('id', doc_id) as doc_id", "text")
    assert {r.component_id for r in simhash.near_duplicates(named).where("doc_id in ('id1', 'id2')").collect()} == {"id1", "id2"}


def test_every_pair_within_the_bound_meets():
    random = np.random.default_rng(5)
    anchors = simhash.Anchors()
    own = random.integers(-(2**63), 2**63 - 1, 3000)
    for half, (place, anchor) in enumerate(anchors.homes(own)):
        assert (place == np.arange(len(own))).all()
        words = own >> 32 * (1 - half) & 0xFFFFFFFF
        assert np.bitwise_count(words ^ (anchor & 0xFFFFFFFF)).max() <= simhash.RADIUS
    flips = np.zeros(len(own), np.uint64)
    for row in range(len(own)):
        for bit in random.choice(64, row % (simhash.MOST_BITS + 1), replace=False):
            flips[row] ^= np.uint64(1 << int(bit))
    other = (own.view(np.uint64) ^ flips).view(np.int64)
    homes = np.stack([anchor for _, anchor in anchors.homes(own)])
    met = np.zeros(len(own), bool)
    for place, anchor in anchors.visits(other):
        np.logical_or.at(met, place, (homes[:, place] == anchor).any(axis=0))
    assert met.all()


@pytest.mark.parametrize("spread", [3, 6, 9])
def test_a_dense_group_of_fingerprints(spark, spread):
    """Thousands of fingerprints around one, some of them near each other only by others."""
    random = np.random.default_rng(spread)
    prints = np.full(3000, 0x0123456789ABCDEF, np.uint64)
    for row in range(len(prints)):
        for bit in random.choice(64, spread, replace=False):
            prints[row] ^= np.uint64(1 << int(bit))
    rows = [(i, int(f)) for i, f in enumerate(prints.tolist())]
    frame = spark.createDataFrame([(i, int(f)) for i, f in enumerate(prints.view(np.int64).tolist())], "doc_id bigint, fingerprint bigint")
    found = simhash.linked(frame)
    assert sorted(map(tuple, found.collect())) == sorted(slow_components(rows))
