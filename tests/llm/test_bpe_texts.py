"""Registered query op3 against the tokenizers library, and slices of a batch."""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradepanel.llm import bpe
from tradepanel.llm.queries import QUERIES, WORD_BPE


def slow(doc_id, text, library):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    joined = " ".join(map(str, ids))
    return (doc_id, len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in (joined, decoded)])


def plain_library():
    library = Tokenizer.from_file(WORD_BPE)
    library.no_truncation()
    library.no_padding()
    return library


def test_query_against_the_library(spark, sf_dir):
    library = plain_library()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = QUERIES["op3_bpe"](spark, sf_dir)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, found.collect())) == sorted(slow(r.doc_id, r.text, library) for r in docs)


def test_other_columns_and_clashing_names(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    docs = docs.withColumns({"ids": F.lit("x"), "at`s": F.current_timestamp(), "text__": F.lit(1)})
    docs = docs.unionByName(docs.limit(3).withColumn("text", F.lit(None).cast("string")))
    whole = bpe.encode(docs, WORD_BPE, ("ids", "decoded", "n_tokens"))
    assert set(whole.columns) == {*docs.columns, "ids", "decoded", "n_tokens"}
    library = plain_library()
    rows = whole.collect()
    assert len(rows) == 43
    for row in rows:
        assert row.ids == library.encode(row.text or "", add_special_tokens=False).ids and row.n_tokens == len(row.ids)
        assert row.text__ == 1
    assert bpe.encode(docs.where("false"), WORD_BPE).count() == 0


def test_slices_of_a_batch(monkeypatch):
    texts = ["a" * n for n in (0, 3, 50, 1, 1, 200, 4)] + [None, "é" * 3]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["i", "t"])
    monkeypatch.setattr(bpe, "SLICE_BYTES", 52)
    parts = [part.column(0).to_pylist() for part in bpe._slices(batch)]
    assert parts == [[0, 1], [2, 3, 4], [5], [6, 7, 8]]
    assert list(bpe._slices(batch.slice(0, 0))) == []


def test_small_tables_change_nothing(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(50).collect()]
    content = open(WORD_BPE, "rb").read()
    small, library = bpe.Encoder(content, 20_000), plain_library()
    for text in texts:
        ids = " ".join(x[1] for x in small.encoded(text))
        assert ids == " ".join(map(str, library.encode(text, add_special_tokens=False).ids))
    assert 0 < small.chunks.held <= 7_500


def test_a_table_of_bounded_bytes():
    from tradepanel.llm.common import BoundedBytes

    made = []
    table = BoundedBytes(lambda key: made.append(key) or key * 2, 16, lambda key, value: 4)
    assert [table[i] for i in (1, 2, 3, 1, 4, 1, 2)] == [2, 4, 6, 2, 8, 2, 4]
    assert made == [1, 2, 3, 4, 2]  # 1 was used while it was old, 2 was not
    assert len(table) + len(table.old) <= 4 and table.held <= 8
