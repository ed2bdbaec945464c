"""Stages that turn raw documents into packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import decontaminate, jaccard, packing, queries, secrets, toxicity
from orderlens.llm.anchors import pair_of
from orderlens.llm.common import table
from orderlens.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject; rows whose id repeats share the worst verdict."""
    scores = toxicity.toxicity_scores(docs, table(spark, sf_dir, "labels"), threshold=0.7)
    toxic = scores.where("predicted = 1").select(F.col("doc_id").alias("toxic_id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own_id"))
    return rows.join(toxic, F.col("own_id").eqNullSafe(F.col("toxic_id")), "left_anti").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one with the least id; of repeated rows one stays."""
    found = jaccard.near_duplicates(docs)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("d", "key").distinct()
    d, key = pair_of(docs)
    first = docs.select(F.struct("*").alias("row"), d.alias("d"), key.alias("key"))
    return first.join(kept, ["d", "key"], "left_semi").dropDuplicates(["d", "key"]).select("row.*")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and n_chars counted anew where one was."""
    return secrets.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents in sequences of 1024 tokens."""
    return packing.pack(docs, end_id=0, capacity=1024, **queries.vocabulary_files())


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", mask_secrets),
    ("packing", pack),
]
ORACLE_SQL = None  # neither training nor token ids can be expressed in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
