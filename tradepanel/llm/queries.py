"""The registered queries of this package, each with its check SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    chat,
    decontamination,
    divergence,
    fingerprints,
    line_dedup,
    near_dedup,
    oracles,
    periodic_runs,
    pii,
    quality,
    sharding,
    simhash,
    token_counts,
)
from .common import documents

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 1024


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of every document and of its edited text."""
    found = fingerprints.fingerprint_edits(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets are at least 0.85 alike."""
    return near_dedup.near_duplicates(documents(spark, sf_dir)).drop("text_hash")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    outputs = ("n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.encode(documents(spark, sf_dir), WORD_BPE, outputs, keep=("doc_id",))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: four certain kinds, and credentials as learnt."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = pii.find_personal_data(docs, weights=pii.train(docs))
    base = F.array_join(F.concat(*[pii.written(kind) for kind in pii.KINDS]), ",")
    spans = F.array_join(F.concat(*[pii.written(kind) for kind in (*pii.KINDS, pii.SECRET)]), ",")
    return found.select(
        "doc_id",
        *[F.size(f"{kind}_spans").cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        spans.alias("spans"),
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = sharding.shard(docs, keep_text=False)
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model that has not seen the held-out labels."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = quality.score(docs, model)
    return found.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines that go, each with its keeper, and what stays."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = line_dedup.without_repeated_lines(docs)
    entry = F.transform(
        "dropped", lambda d: F.concat_ws(":", d.line_no, d.keeper_doc_id, d.keeper_line_no, d.edits)
    )
    return found.select(
        "doc_id",
        F.size("dropped").cast("bigint").alias("n_dropped"),
        F.array_join(entry, ",").alias("dropped"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_leaks(docs, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that holds control strings, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = rows.unionByName(own).withColumn("content", chat.text_part(F.col("text")))
    return chat.conversation_digests(turns)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they exceed a context of 1,024."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = token_counts.token_counts(docs, BYTE_BPE)
    return found.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose SimHash fingerprints differ in at most four bits."""
    return simhash.near_duplicates(documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, and what is left without their repeats.

    The contract makes about a tenth of the documents periodic from some word on.
    """
    docs = made_periodic(documents(spark, sf_dir))
    found = periodic_runs.periodic_runs(docs, outputs=("runs", "collapsed_sha256"))
    found = found.withColumn("longest", periodic_runs.longest(F.col("runs")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.call_function("div", 1000 * F.col("longest.length"), F.col("longest.period")).alias("exponent_milli"),
        F.sha2(periodic_runs.as_lines(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


def made_periodic(docs: DataFrame) -> DataFrame:
    """The documents, those that the contract picks with a part that repeats."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(F.pmod(h, F.lit(10)) == 0, words).alias("words"))
    size = F.size("words").cast("bigint")
    a = F.when(size > 0, F.pmod("g", size))
    rows = rows.withColumn("a", a).withColumn("p", 1 + F.floor((size - F.col("a")) / (3 + F.pmod("g", F.lit(8)))))
    place = lambda i: (F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int")
    repeated = F.transform("words", lambda word, i: F.when(i < F.col("a"), word).otherwise(F.get("words", place(i))))
    text = F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's distance from the others of its language, and its own terms."""
    return divergence.divergence(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_near_dedup": op2_near_dedup,
    "op3_bpe": op3_bpe,
    "op4_pii": op4_pii,
    "op5_sharding": op5_sharding,
    "op6_quality": op6_quality,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_chat": op9_chat,
    "op10_token_counts": op10_token_counts,
    "op11_simhash": op11_simhash,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_divergence": op13_divergence,
}
ORACLES: dict[str, str] = {
    "op2_near_dedup": oracles.NEAR_DEDUP,
    "op7_line_dedup": oracles.LINE_DEDUP,
    "op8_decontamination": oracles.DECONTAMINATION,
    "op9_chat": oracles.CHAT,
    "op13_divergence": oracles.DIVERGENCE,
}
