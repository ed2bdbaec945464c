"""Row-level cleanup of the six inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens import schemas
from orderlens.functions.expressions import parse_timestamp, tidy_text


def _parse_times(df: DataFrame, spec: schemas.TableSpec) -> DataFrame:
    times = [c for c, t in spec.columns.items() if t == schemas.TIME and c in df.columns]
    return df.withColumns({c: parse_timestamp(F.col(c)) for c in times})


def clean_customers(df: DataFrame) -> DataFrame:
    """City names in lower case."""
    return df.withColumn("customer_city", F.lower("customer_city"))


def clean_products(df: DataFrame) -> DataFrame:
    """A missing category becomes 'unknown'."""
    return df.fillna("unknown", subset=["product_category_name"])


def clean_orders(df: DataFrame) -> DataFrame:
    """The five time columns parsed; malformed ones become null."""
    return _parse_times(df, schemas.ORDERS)


def clean_reviews(df: DataFrame) -> DataFrame:
    """Both text columns on one line and stripped, both time columns parsed."""
    texts = ["review_comment_title", "review_comment_message"]
    return _parse_times(df.withColumns({c: tidy_text(F.col(c)) for c in texts}), schemas.REVIEWS)


def clean_order_items(df: DataFrame) -> DataFrame:
    """The shipping limit parsed."""
    return _parse_times(df, schemas.ORDER_ITEMS)


def clean_category_names(df: DataFrame) -> DataFrame:
    """Nothing to clean."""
    return df
