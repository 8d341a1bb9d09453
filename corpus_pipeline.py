"""The corpus pipeline: quality, line dedup, near-duplicates, decontamination, BPE.

Every stage is a function of (spark, docs, sf_dir) that gets all documents that the
stage before has kept. Its result is written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepanel.llm import bpe, decontamination, line_dedup, near_dedup, quality
from tradepanel.llm.common import documents
from tradepanel.sources.tables import stored

#: Similarity of near-duplicates, in hundredths (query op2 has 85 from its contract).
NEAR_PERCENT = 80
#: Bytes of encoded words that a worker keeps: less than elsewhere, since workers that have
#: run the stages before still hold memory for them.
ENCODED_BYTES = 24 << 20
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the classifier rejects go.

    It learns from labelled documents among those that it gets, held-out ones excepted.
    Without any label nothing is known and all documents stay. An empty text is
    scored like any other.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels)
    if not model.tables:
        return docs
    scored = quality.score(docs, model, output="score__")
    return scored.where(F.col("score__") >= quality.THRESHOLD).drop("score__")


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: lines that are equal or near to an earlier line of any document go.

    ``n_chars`` follows the text. A document of which no line is left goes; one that
    was empty before stays.
    """
    cut = line_dedup.without_repeated_lines(docs)
    emptied = (F.size("dropped") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    kept = cut.where(~F.coalesce(emptied, F.lit(False)))
    length = F.when(F.size("dropped") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length).select(docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of near-duplicates (0.8 or more) the document with the smallest id stays.

    Rows of a kept document with the same text are one row, the least in the other
    columns. Of rows without a doc_id one of each shingle set stays, if no row with an
    id has that set; those without a word all stay.
    """
    found = near_dedup.near_duplicates(docs, percent=NEAR_PERCENT)
    gone = found.where("not kept and doc_id is not null").select("doc_id", F.col("text_hash").alias("hash__"))
    gone = stored(gone.distinct(), "near-copies")
    left = docs.where("doc_id is not null").withColumn("hash__", F.xxhash64("text"))
    left = left.join(gone, ["doc_id", "hash__"], "left_anti").select(docs.columns)
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("times__"))
    twice = stored(ids.where("times__ > 1").select("doc_id"), "repeated-ids")
    if not twice.isEmpty():
        copies = _least_rows(left.join(twice, "doc_id", "left_semi"), ["doc_id", "text"])
        left = left.join(twice, "doc_id", "left_anti").select(docs.columns).unionByName(copies.select(docs.columns))
    nameless = docs.where("doc_id is null")
    if nameless.isEmpty():
        return left
    set_key = near_dedup.signature(F.col("text"))["set_key"].alias("set__")
    nameless = stored(nameless.select("*", set_key), "rows-without-id")
    known = docs.where("doc_id is not null").select(set_key)
    worded = nameless.where(F.length("set__") > 0).join(known, "set__", "left_anti")
    worded = _least_rows(worded, ["set__"])
    empty = nameless.where(F.length("set__") == 0)
    return left.unionByName(worded.select(docs.columns)).unionByName(empty.select(docs.columns))


def _least_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each value of the keys: the least in the other columns."""
    others = F.struct(*[c for c in rows.columns if c not in keys])
    return rows.groupBy(*keys).agg(F.min(others).alias("least__")).select(*keys, "least__.*")


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a window of a benchmark item go."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: ids of every text that is left, and digests of ids and decoded text.

    A null text has no ids and the digests of an empty one; repeated rows stay."""
    outputs = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
    return bpe.encode(docs, WORD_BPE, outputs, keep=("doc_id",), kept_bytes=ENCODED_BYTES)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", distinct_lines),
    ("near-duplicates", distinct_documents),
    ("benchmark decontamination", clean_documents),
    ("BPE encoding", encoded_documents),
]

#: The classifier cannot be written in SQL. Tests check that each stage only takes rows away,
#: that no equal line and no near pair is left, and small cases of the stages for lines and
#: near-duplicates row by row; they do not check that every row a stage takes is the right one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
