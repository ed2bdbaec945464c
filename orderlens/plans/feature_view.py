"""The order feature view.

Join order is chosen so that every join side comes straight from an exchange: Spark can
then split a hot product or a hot order at run time.  No side is broadcast by hint;
the optimizer does so from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import schemas
from orderlens.functions import expressions as E
from orderlens.schemas import Relations

VIEW_NAME = "features_view"


def delivered_orders(orders: DataFrame) -> DataFrame:
    """Orders that reached the customer."""
    return orders.where(
        (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNotNull()
    )


def order_items_agg(order_items: DataFrame) -> DataFrame:
    """One row per order: highest item number, sums, last shipping limit, dearest product.

    Ties in price go to the lowest item number, then the lowest product id; a null price
    never wins over a known one.
    """
    dearest_first = F.struct(
        F.col("price").isNull(), (-F.col("price")).alias("negated"), F.col("order_item_id"), F.col("product_id")
    )
    return order_items.groupBy("order_id").agg(
        F.max("order_item_id").alias("num_items"),
        F.sum("price").alias("total_price"),
        F.sum("freight_value").alias("total_freight"),
        F.max("shipping_limit_date").alias("limit_date"),
        F.min(dearest_first)["product_id"].alias("most_imp_product_id"),
    )


def join_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their item totals; orders without items drop out."""
    return orders.join(items, "order_id")


def join_products(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Attributes of the most important product."""
    return rows.join(products, rows.most_imp_product_id == products.product_id)


def join_category(rows: DataFrame, category_names: DataFrame) -> DataFrame:
    """English category name where there is one."""
    return rows.join(category_names, "product_category_name", "left")


def join_reviews(rows: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per order and review."""
    return rows.join(
        reviews.select("order_id", "review_id", "review_score", "review_answer_timestamp"), "order_id"
    )


def product_features() -> dict:
    """Expressions over product and category columns."""
    c = F.col
    incomplete = (
        c("product_name_lenght").isNull()
        | c("product_description_lenght").isNull()
        | c("product_photos_qty").isNull()
        | c("product_weight_g").isNull()
    )
    return {
        "name_len": F.coalesce(c("product_name_lenght"), F.lit(0)),
        "desc_len": F.coalesce(c("product_description_lenght"), F.lit(0)),
        "category": F.coalesce(c("product_category_name_english"), c("product_category_name")),
        "prod_photos": F.coalesce(c("product_photos_qty"), F.lit(0)),
        "weight_g": F.coalesce(c("product_weight_g"), F.lit(0)),
        "volume_l": E.volume_litres(c("product_length_cm"), c("product_height_cm"), c("product_width_cm")),
        "has_missing_details": E.flag(incomplete),
    }


def order_features() -> dict:
    """Expressions over order times and item totals."""
    c = F.col
    delivered, estimated = c("order_delivered_customer_date"), c("order_estimated_delivery_date")
    carrier, limit = c("order_delivered_carrier_date"), c("limit_date")
    return {
        "freight_ratio": E.freight_ratio(c("total_freight"), c("total_price")),
        "delivery_days": E.days_between(delivered, c("order_purchase_timestamp")),
        "estimated_delivery_diff": E.days_between(delivered, estimated),
        "seller_disp_diff": E.days_between(carrier, limit),
        "processing_days": E.days_between(carrier, c("order_approved_at")),
        "is_seller_late": E.flag(carrier > limit),
        "is_delivery_late": E.flag(delivered.cast("date") > estimated.cast("date")),
    }


def product_facts(products: DataFrame, category_names: DataFrame) -> DataFrame:
    """Product features, one row per product.

    Categories are few and very uneven, so their names are joined to the products, never
    to the much longer list of orders.
    """
    rows = join_category(products, category_names)
    return rows.select("product_id", *[e.alias(n) for n, e in product_features().items()])


def order_facts(tables: Relations) -> DataFrame:
    """All features but the review score, one row per delivered order with items.

    Order and product expressions are computed before the two meet, so only short columns
    travel through the exchange of the join.
    """
    rows = join_items(delivered_orders(tables.orders), order_items_agg(tables.order_items))
    rows = rows.select(
        "order_id",
        "most_imp_product_id",
        "num_items",
        "total_price",
        "total_freight",
        *[e.alias(n) for n, e in order_features().items()],
    )
    rows = join_products(rows, product_facts(tables.products, tables.category_names))
    wanted = [c for c in schemas.FEATURE_COLUMNS if c not in ("review_score", "bad_score")]
    return rows.select("order_id", *wanted)


def with_scores(rows: DataFrame) -> DataFrame:
    """Label the rows and put keys and features in view order."""
    labelled = rows.withColumn("bad_score", E.is_bad_score(F.col("review_score")))
    return labelled.select(*schemas.KEY_COLUMNS, *schemas.FEATURE_COLUMNS)


def feature_view(tables: Relations) -> DataFrame:
    """Keys and 19 features, one row per delivered order and review."""
    return with_scores(join_reviews(order_facts(tables), tables.reviews))


def create_feature_view(tables: Relations) -> DataFrame:
    """Register the view under its name; queries on it are optimized as a whole."""
    view = feature_view(tables)
    view.createOrReplaceTempView(VIEW_NAME)
    return view


def view_scan(spark: SparkSession, limit: int | None = None) -> DataFrame:
    """All rows of the registered view, or any ``limit`` of them; 0 means none."""
    view = spark.table(VIEW_NAME)
    return view if limit is None else view.limit(limit)
