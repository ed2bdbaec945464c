"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    bwt,
    conversations,
    decontaminate,
    jaccard,
    language_model,
    line_quality,
    manifest,
    packing,
    repeats,
    secrets,
    sql,
    tokens,
    topk,
    toxicity,
)
from orderlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_files() -> dict[str, str]:
    """The 50k byte-level vocabulary, and the same as ranks."""
    import public_tokenizers

    return {
        "vocabulary": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, and whether they are more than 1024."""
    return tokens.token_counts(table(spark, folder, "documents"), limit=1024, **vocabulary_files())


def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """Five greatest inner products of every fiftieth vector."""
    vectors = topk.integers(table(spark, folder, "embeddings"), 256)
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op3_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-entropy difference of every document between those labelled good and all."""
    good = table(spark, folder, "labels").where("quality = 1")
    return language_model.entropy_difference(table(spark, folder, "documents"), good)


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the similarity."""
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that are left when passages of 35 words found elsewhere are removed."""
    found = repeats.remove_repeats(table(spark, folder, "documents"), length=35)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets in every document."""
    found = secrets.secret_spans(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE))
    counts = [F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long") for i in range(len(secrets.BASE))]
    return found.select(
        "doc_id",
        *[n.alias(f"n_{r.kind}") for n, r in zip(counts, secrets.BASE)],
        F.sha2(secrets.named(base), 256).alias("base_sha256"),
        secrets.named(F.col("spans")).alias("spans"),
    )


def op7_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate component of every document."""
    found = jaccard.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from the labelled rows that are not held out."""
    return toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"), threshold=0.7)


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document that are left when strings of 50 bytes of earlier documents are removed."""
    found = bwt.remove_repeated_bytes(table(spark, folder, "documents"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, end id 0."""
    return packing.pack(table(spark, folder, "documents"), end_id=0, capacity=1024, **vocabulary_files())


def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether the row as tampered with still leads to the root."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(hit, F.translate("text", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col("text"))
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = manifest.row_hash([text if c == "text" else F.col(c) for c in columns])
    found = manifest.merkle_manifest(
        table(spark, folder, "documents"), columns, "lang", "doc_id", carried={"tampered": F.when(hit, tampered)}
    )
    folded = manifest.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))



def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Damage, and the cheapest repair, of every conversation."""
    given = table(spark, folder, "conversations")
    repaired = conversations.repair(conversations.damaged(given))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = repaired.report.drop("conv_id").join(conversations.digests(repaired.turns), "c", "left")
    key = conversations.key(F.col("conv_id"))
    every = given.select(F.col("conv_id").cast("long").alias("conv_id"), key.alias("c")).distinct().join(found, "c", "left")
    return every.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )



def op13_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learnt from the labelled rows that are not held out."""
    return line_quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"), threshold=0.3)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_top_k,
        op3_language_model,
        op4_decontamination,
        op5_substring_dedup,
        op6_secrets,
        op7_jaccard,
        op8_toxicity,
        op9_suffix_dedup,
        op10_packing,
        op11_manifest,
        op12_conversations,
        op13_quality,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op2_top_k": sql.top_k(),
    "op5_substring_dedup": sql.word_repeats(),
    "op7_jaccard": sql.near_duplicates(),
    "op9_suffix_dedup": sql.byte_repeats(),
    "op11_manifest": sql.manifest(),
}
