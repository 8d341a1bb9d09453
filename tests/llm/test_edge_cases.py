"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradepanel.llm import (
    bpe,
    chat,
    decontamination,
    fingerprints,
    line_dedup,
    near_dedup,
    pii,
    quality,
    sharding,
    token_counts,
)
from tradepanel.llm.queries import BYTE_BPE, QUERIES, WORD_BPE

LINE = "one two three four five six seven eight nine ten"
LONG = " ".join(f"word{i}" for i in range(30_000))
TEXTS = [
    (1, LINE),
    (2, LINE),
    (2, LINE),
    (3, None),
    (4, ""),
    (5, " \t\n"),
    (6, "a"),
    (7, LONG),
    (8, LONG + " end"),
    (9, "Mail a@b.cx%y@z.w from 1.2.3.4 and 300.1.1.1, card 4111 1111 1111 1111, +1 (555) 555-0100"),
    (10, "<|endoftext|> we'll  don't\n\n<|startoftext|>"),
    (11, LINE.replace("five", "5")),
    (None, LINE),
    (None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1, 2, "y") for i, t in TEXTS]
    names = "doc_id bigint, text string, items string, shard int, n int, lang string"
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def by_id(df):
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


def test_near_duplicates(docs, nothing):
    found = near_dedup.near_duplicates(docs)
    assert found.count() == len(TEXTS)
    rows = by_id(found)
    assert [rows[i].component_id for i in (1, 2, 7, 8)] == [1, 1, 7, 7]
    assert [rows[i].n_shingles for i in (3, 4, 5, 6, 1)] == [0, 0, 0, 1, 6]
    assert [rows[i].kept for i in (1, 2, 3, 4, 5, 6, 8)] == [True, False, True, True, True, True, False]
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_hub_without_similar_copies(spark):
    """Copies that are linked with their original only, through which they are one class."""
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base)]
    for k in range(60):
        words = list(base)
        for at in (3 * k + 5, 3 * k + 8, 3 * k + 11):
            words[at % 200] = f"new{k}x{at}"
        texts.append(" ".join(words))
    rows = [(100 - i, t) for i, t in enumerate(texts)]
    sets = [set(near_dedup.shingle_set(t).tolist()) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 85 * len(a | b):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        smallest[root(i)] = min(doc, smallest.get(root(i), doc))
    found = by_id(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert {d: r.component_id for d, r in found.items()} == {d: smallest[root(i)] for i, (d, _) in enumerate(rows)}


def test_bpe_and_counts_equal_the_library(docs, nothing):
    whole = bpe.encode(docs, WORD_BPE, ("ids", "decoded", "n_tokens"))
    library = Tokenizer.from_file(WORD_BPE)
    for r in whole.collect():
        wanted = library.encode(r.text or "", add_special_tokens=False)
        assert r.ids == wanted.ids and r.n_tokens == len(wanted.ids)
        assert r.decoded == library.decode(wanted.ids, skip_special_tokens=False)
    again = bpe.decode(whole.withColumnRenamed("decoded", "first"), WORD_BPE)
    assert again.where("decoded <> first").count() == 0
    assert bpe.encode(nothing, WORD_BPE).count() == 0
    library = Tokenizer.from_file(BYTE_BPE)
    short = docs.where("text is null or length(text) < 200")
    for r in token_counts.prefix_counts(token_counts.token_counts(short, BYTE_BPE), BYTE_BPE).collect():
        text = r.text or ""
        counts = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert r.prefix_counts == counts and r.n_tokens == counts[-1]


def test_budgets(spark):
    df = spark.createDataFrame([([0, 1, 2, 1, 3],)], "c array<int>")
    row = df.select(
        token_counts.longest_prefix("c", 1).alias("a"),
        token_counts.longest_prefix("c", -1).alias("b"),
        token_counts.tokens_before("c", 99).alias("d"),
    ).first()
    assert (row.a, row.b, row.d) == (3, None, 3)


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(t - 9 if t > 9 else t for t in twice) % 10 == 0


def test_personal_data(docs, nothing):
    found = by_id(pii.find_personal_data(docs, weights=pii.train(docs)))
    text = found[9].text
    wanted = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    assert [(s.start, s.end) for s in found[9].email_spans] == wanted and len(wanted) == 2
    assert [s.value for s in found[9].ip_spans] == ["1.2.3.4"]
    assert [s.value for s in found[9].card_spans] == ["4111 1111 1111 1111"] and luhn("4111111111111111")
    assert [s.value for s in found[9].phone_spans] == ["+1 (555) 555-0100"]
    assert found[3].email_spans == [] and found[4].phone_spans == []
    assert pii.train(nothing) is None and pii.find_personal_data(nothing).count() == 0


def test_credentials_are_learnt_and_masked(spark):
    key = hashlib.sha1(b"x").hexdigest()
    rows = [(i, f'set token = "{hashlib.sha1(bytes([i])).hexdigest()}" now') for i in range(30)]
    rows += [(i, f"the name abcdefghijklmnopqrst{i} is a word") for i in range(30, 60)] + [(99, f"secret: {key}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = pii.masked(pii.find_personal_data(docs, weights=pii.train(docs)))
    rows = by_id(found)
    assert all(len(rows[i].secret_spans) == (i < 30 or i == 99) for i in rows)
    assert rows[99].masked == "secret: [secret]" and rows[40].masked == rows[40].text


def test_sharding(docs, nothing):
    found = sharding.shard(docs, shards=4).collect()
    assert len(found) == len(TEXTS)
    for shard in range(4):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert {r.size for r in found if r.text is None} == {8}
    assert sharding.shard(nothing).count() == 0


def test_quality(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 1), (6, 0), (7, None), (None, 1), (77, 0)], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    scores = [r.score for r in quality.score(docs, model).collect()]
    assert len(scores) == len(TEXTS) and all(0 <= s <= 1 for s in scores)
    empty = quality.train(nothing, labels.where("false"))
    assert not empty.tables and quality.score(nothing, empty).count() == 0


def test_quality_on_held_out_labels(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id")
    held = scored.where(quality.held_out(F.col("doc_id"))).collect()
    right = sum((r.score >= quality.THRESHOLD) == (r.quality == 1) for r in held)
    assert right >= 0.95 * len(held)


def test_line_dedup(docs, nothing):
    found = by_id(line_dedup.without_repeated_lines(docs))
    assert found[1].text == LINE and found[1].dropped == []
    assert found[2].text == "" and found[2].dropped[0].keeper_doc_id == 1
    assert found[11].dropped[0].edits == 1 and found[11].dropped[0].keeper_doc_id == 1
    assert found[3].text is None and found[7].text == LONG
    assert [d.edits for d in found[8].dropped] == [1]
    assert line_dedup.without_repeated_lines(docs).count() == len(TEXTS)
    assert line_dedup.repeated_lines(nothing).count() == 0


def test_decontamination(spark, docs, nothing):
    items = spark.createDataFrame([(1, "TWO three, Four"), (2, LINE), (3, None), (4, "!?"), (None, "zz")], "item_id bigint, text string")
    found = by_id(decontamination.with_spans(decontamination.find_leaks(docs, items)))
    assert found[1]["items"] == ["1", "2"] and len(found[1].hits) == 10
    assert found[11]["items"] == ["1"] and found[11].hits == [1, 2, 3]
    (span,) = found[11].spans
    assert found[11].text[span.start : span.end] == "two three four"
    assert found[3].n_words == 0 and found[3].hits == []
    blocks = by_id(decontamination.find_leaks(docs, items, block_bytes=20))
    assert {i: (r.hits, r["items"]) for i, r in blocks.items()} == {i: (r.hits, r["items"]) for i, r in found.items()}
    assert decontamination.find_leaks(nothing, items).count() == 0
    assert decontamination.find_leaks(docs, items.where("false")).where("size(hits) > 0").count() == 0
    assert set(decontamination.without_leaks(docs, items).columns) == set(docs.columns)


def test_fingerprints(docs, nothing):
    found = fingerprints.fingerprint_edits(docs).collect()
    assert len(found) == len(TEXTS)
    same = {tuple(r.sketch) for r in found if r.text == LINE}
    assert len(same) == 1 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert fingerprints.fingerprint_edits(nothing).count() == 0
    parts = docs.select("lang", fingerprints.sketch(F.col("text")).alias("sketch"))
    (whole,) = fingerprints.merged(parts, ["lang"]).collect()
    everything = sorted({h for r in parts.collect() for h in r.sketch})[: fingerprints.K]
    assert whole.sketch == everything


def test_chat(spark):
    rows = [
        (1, 0, "user", r"a <|end|> <\|turn|> b", None),
        (1, 1, "assistant", "x\ny", None),
        (1, 1, "assistant", "x\ny", None),
        (1, None, None, None, None),
        (2, 0, "assistant", "", "image"),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, kind string")
    image = "array(named_struct('type', 'text', 'text', 'see', 'uri', null, 'width', null, 'height', null, 'seconds', null, 'pages', null), named_struct('type', 'image', 'text', null, 'uri', 'f.png', 'width', 1000L, 'height', 600L, 'seconds', null, 'pages', null))"
    content = F.when(F.col("kind") == "image", F.expr(image).cast(f"array<{chat.PART}>")).otherwise(chat.text_part(F.col("text")))
    found = {r.conv_id: r for r in chat.format_conversations(turns.withColumn("content", content)).collect()}
    said = [(role, text) for role, text, _, _ in chat.turns_of(found[1].formatted)]
    assert said == [("", ""), ("user", rows[0][3]), ("assistant", "x\ny"), ("assistant", "x\ny")]
    assert found[2].formatted == "<|turn|>assistant\nsee<|image:1|><|end|>\n"
    assert [(a.uri, a.tokens) for a in found[2].attachments] == [("f.png", 4 * 256)] and found[2].attachment_tokens == 1024


def test_chat_of_one_conversation_in_stretches(spark):
    rows = [(None, i if i % 3 else None, "user" if i % 2 else "assistant", f"text {i % 100}") for i in range(1000)]
    rows += [(1 << 60, 5, "assistant", f"t{i}") for i in range(300)] + [((1 << 60) + 1, 0, None, None)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    turns = turns.withColumn("content", chat.text_part(F.col("text")))
    stretches = chat.format_stretches(turns).collect()
    assert all(r.formatted.count("<|turn|>") <= chat.STRETCH for r in stretches)
    whole = {r.conv_id: r.formatted for r in chat.format_conversations(turns).collect()}
    pieces = sorted(stretches, key=lambda r: r.stretch)
    assert whole == {i: "".join(r.formatted for r in pieces if r.conv_id == i) for i in whole}
    digests = chat.conversation_digests(turns)
    plan = digests._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "ObjectHashAggregate" not in plan
    found = {r.conv_id: tuple(r)[1:] for r in digests.collect()}
    assert found == {i: chat._read(text) for i, text in whole.items()}
    for conv_id in whole:
        said = sorted(((t if t is not None else -(1 << 63)), r or "", x or "") for i, t, r, x in rows if i == conv_id)
        wanted = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in said).encode()).hexdigest()
        assert found[conv_id][:2] == (len(said), wanted)
    assert chat.conversation_digests(turns.where("false")).count() == 0


def test_op9_gathers_no_conversation(spark, sf_dir):
    plan = QUERIES["op9_chat"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_vocabularies_are_public():
    assert WORD_BPE == public_tokenizers.path("word_bpe_49k.json")
