"""Cleaning of the feature view."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens import schemas
from orderlens.plans import feature_view as fv
from orderlens.schemas import Relations

CARRIED = ["order_id", *schemas.FEATURE_COLUMNS]
# Later rows win; nulls count as earliest.  Rows equal in all of these are equal in every feature.
LATEST = ["review_answer_timestamp", "review_id", "review_score"]


def drop_nulls(df: DataFrame) -> DataFrame:
    """Rows complete in order_id and all features; helper columns do not matter."""
    return df.dropna("any", subset=[c for c in CARRIED if c in df.columns])


def dedup_keep_last(df: DataFrame, order_by: list[str] = tuple(LATEST)) -> DataFrame:
    """One row per order: the last in ``order_by``.

    Spark keeps the best row per order of each task before the exchange, so an order
    with very many reviews does not travel or pile up.
    """
    newest_first = Window.partitionBy("order_id").orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    return df.withColumn("_place", F.row_number().over(newest_first)).where(F.col("_place") == 1).drop("_place")


def cast_day_columns(df: DataFrame) -> DataFrame:
    """Day columns as int, truncated."""
    return df.withColumns({c: F.col(c).cast("int") for c in schemas.DAY_COLUMNS})


def clamp_processing_days(df: DataFrame) -> DataFrame:
    """Negative processing time is a recording error and becomes 0; null stays null."""
    days = F.col("processing_days")
    return df.withColumn("processing_days", F.when(days < 0, 0).otherwise(days))


def clean_data(view: DataFrame) -> DataFrame:
    """Complete rows, one per order, days as int and not negative where that is impossible.

    ``order_id`` is carried as the row key; it is not a feature.
    """
    return clamp_processing_days(cast_day_columns(dedup_keep_last(drop_nulls(view)))).select(*CARRIED)


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """The last scored review of each order."""
    return dedup_keep_last(
        reviews.select("order_id", "review_id", "review_score", "review_answer_timestamp").where(
            F.col("review_score").isNotNull()
        )
    )


def reviewed_orders(tables: Relations) -> DataFrame:
    """``dedup_keep_last(drop_nulls(feature_view))`` with the work before the join.

    Only ``review_score`` differs between the rows of an order, so null removal and
    duplicate removal can run on the reviews alone: the join then meets one review per
    order and nothing fans out.
    """
    facts = drop_nulls(fv.order_facts(tables))
    return fv.with_scores(fv.join_reviews(facts, latest_reviews(tables.reviews))).select(*CARRIED)


def scorable_orders(tables: Relations) -> DataFrame:
    """Delivered orders with all facts, reviewed or not: what a model is asked about."""
    return clamp_processing_days(cast_day_columns(drop_nulls(fv.order_facts(tables))))


def cleaned_orders(tables: Relations) -> DataFrame:
    """Same rows as ``clean_data(feature_view(tables))``, planned from the tables."""
    return clamp_processing_days(cast_day_columns(reviewed_orders(tables)))
