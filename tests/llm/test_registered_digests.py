"""Registered queries against plain Python versions of their contracts, all rows."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tradepanel.llm import sharding
from tradepanel.llm.queries import BYTE_BPE, QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()))


def rows(spark, sf_dir, name):
    return {r.doc_id: r for r in QUERIES[name](spark, sf_dir).collect()}


def shingles(text):
    words = re.split(r"[\x20\x09-\x0D]+", text.lower())
    words = [w for w in words if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_op1_texts_and_likeness(spark, sf_dir, docs):
    found = rows(spark, sf_dir, "op1_fingerprints")
    assert len(found) == len(docs)
    off, same = [], defaultdict(set)
    for (doc_id, text), (_, successor) in zip(docs, docs[1:] + docs[:1]):
        row = found[doc_id]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + successor[:cut]
        assert (row.n_chars, row.edited_sha256) == (len(text), sha(edited))
        same[text].add(row.fingerprint)
        off.append(abs(row.near_edited - likeness(shingles(text), shingles(edited))))
        off.append(abs(row.near_next - likeness(shingles(text), shingles(successor))))
    assert all(len(x) == 1 for x in same.values())
    # a sketch of 128: six deviations of the estimate of a share of one half
    assert max(off) < 6 * 0.5 / math.sqrt(128) and np.mean(off) < 0.05


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def valid(kind, text):
    digits = re.sub(r"[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def test_op4_base_spans(spark, sf_dir, docs):
    found, several = rows(spark, sf_dir, "op4_pii"), 0
    for doc_id, text in docs:
        spans = {
            kind: [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text) if valid(kind, m[0])]
            for kind, pattern in PATTERNS.items()
        }
        row = found[doc_id]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [len(x) for x in spans.values()]
        base = [x for kind in PATTERNS for x in spans[kind]]
        assert row.base_sha256 == sha(",".join(base))
        assert set(base) <= set(row.spans.split(",")) | {""}
        several += len(base) > 0
    assert several > 3


def test_op5_shards(spark, sf_dir, docs):
    found, shards, groups = rows(spark, sf_dir, "op5_sharding"), defaultdict(list), defaultdict(set)
    for doc_id, text in docs:
        row, data = found[doc_id], text.encode()
        assert (row.size, row.text_crc32, row.law, row.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        shards[row.shard].append(row)
        groups[text].add(row.shard)
    assert set(shards) <= set(range(24))
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert all(len(x) == 1 for x in groups.values())
    sizes = [sum(r.size for r in shards[i]) for i in range(24)]
    largest = max(len(t.encode()) + 8 for _, t in docs)
    assert max(sizes) - min(sizes) <= largest


def test_groups_of_equal_texts_stay_together(spark):
    """A group of nine tenths of a shard in one shard; one of two shards is divided."""
    rows = [(i, f"{i} " + "x" * 90) for i in range(4800)]
    shard = sum(len(t) + 8 for _, t in rows) / 22
    rows += [(10_000 + i, "same " + "y" * 495) for i in range(int(0.9 * shard / 508))]
    rows += [(20_000 + i, "many " + "z" * 495) for i in range(int(2 * shard / 508))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = sharding.shard(frame).collect()
    assert len({r.shard for r in found if r.text.startswith("same")}) == 1
    assert len({r.shard for r in found if r.text.startswith("many")}) > 1
    sizes = defaultdict(int)
    for r in found:
        sizes[r.shard] += r.size
    assert len(sizes) == 24 and max(sizes.values()) < 1.1 * sum(sizes.values()) / 24


def test_op6_scores(spark, sf_dir, docs):
    found = rows(spark, sf_dir, "op6_quality")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for doc_id, _ in docs:
        row = found[doc_id]
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
    scored = [(found[i].score, q) for i, q in labels.items() if found[i].held_out]
    good, bad = ([s for s, q in scored if q == k] for k in (1, 0))
    assert good and bad
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > 0.8


def test_op10_counts(spark, sf_dir, docs):
    library = Tokenizer.from_file(BYTE_BPE)
    library.no_truncation()
    library.no_padding()
    found = rows(spark, sf_dir, "op10_token_counts")
    for doc_id, text in docs:
        n = len(library.encode(text, add_special_tokens=False).ids)
        row = found[doc_id]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 1024)
