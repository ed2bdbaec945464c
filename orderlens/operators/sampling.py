"""Seeded, exact splits, folds and samples."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.ranks import exact_rank, take_share

SEED = 123


def stratified_split(
    df: DataFrame, test_size: float = 0.2, seed: int = SEED, label: str = "bad_score", id_column: str = "order_id"
) -> DataFrame:
    """Add ``split``: 'train' for the first ``1 - test_size`` of every label, else 'test'."""
    share = str(1 - Decimal(str(test_size)))
    marked = take_share(df, share, id_column, seed, [label], "_train")
    return marked.withColumn("split", F.when(F.col("_train"), "train").otherwise("test")).drop("_train")


def stratified_folds(
    df: DataFrame, n_folds: int = 5, seed: int = SEED, label: str = "bad_score", id_column: str = "order_id"
) -> DataFrame:
    """Add ``fold`` in 0 .. n_folds - 1; folds of a label differ by at most one row."""
    ranked = exact_rank(df, id_column, seed, [label], "_rank")
    return ranked.withColumn("fold", F.pmod(F.col("_rank"), F.lit(n_folds)).cast("int")).drop("_rank")


def validation_sample(df: DataFrame, share: float = 0.2, seed: int = SEED, id_column: str = "order_id") -> DataFrame:
    """An exact share of the rows (rounded half to even), the same ones for the same seed."""
    taken = take_share(df, str(share), id_column, seed, (), "_taken", whole=F.bround)
    return taken.where("_taken").drop("_taken")


def head(df: DataFrame, n: int = 5, order_by: list[str] = ("order_id",)) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order_by).limit(n)
