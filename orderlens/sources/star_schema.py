"""The driver's star-schema tables seen as the six relations.

Keys, parties, prices, product attributes and texts come from the tables.  Times and
scores are arithmetic on keys (the tables hold none that fit), so they exercise the
operators but say nothing about real customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.schemas import Relations

# The columns read from the driver's tables.  Stating them saves a job per
# table that would only read types.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double",
    "documents": "doc_id bigint, text string, lang string, source string",
}


def _after(key: Column, hours: Column | int = 0) -> Column:
    """A time some hours after the purchase of order ``key``.

    Every table derives the time of an order from its key, so no join is needed for it.
    """
    start = F.lit("1992-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("HOUR", key % 2406 * 24 + key * 7 % 24 + hours, start)


def _delivered_hours(key: Column) -> Column:
    return F.when(key % 97 != 0, 72 + key * 17 % 700)


def _estimated_hours(key: Column) -> Column:
    return (key % 14 + 20) * 24


def _scan(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(COLUMNS[table]).parquet(f"{folder.rstrip('/')}/{table}.parquet")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = _scan(spark, folder, "nation"), _scan(spark, folder, "region")
    place = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customer = _scan(spark, folder, "customer")
    return customer.join(place, customer.c_nationkey == place.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.substring("r_name", 1, 2).alias("customer_state"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """``product_category_name`` is null for every 37th product until it is cleaned."""
    key, size = F.col("p_partkey"), F.col("p_size")
    described, measured = key % 29 != 0, key % 31 != 0
    return _scan(spark, folder, "part").select(
        key.alias("product_id"),
        F.when(key % 37 != 0, F.lower("p_type")).alias("product_category_name"),
        F.when(described, F.length("p_name")).cast("int").alias("product_name_lenght"),
        F.when(described, size * 20).cast("int").alias("product_description_lenght"),
        F.when(described, size % 6 + 1).cast("int").alias("product_photos_qty"),
        F.when(measured, size * 100).cast("int").alias("product_weight_g"),
        (key % 40 + 16).cast("int").alias("product_length_cm"),
        (key % 23 + 2).cast("int").alias("product_height_cm"),
        F.when(measured, key % 17 + 11).cast("int").alias("product_width_cm"),
    )


def category_names(spark: SparkSession, folder: str) -> DataFrame:
    """Every product type but one has an English name, so the fallback is exercised."""
    name = F.lower("p_type")
    return (
        _scan(spark, folder, "part")
        .select(name.alias("product_category_name"))
        .distinct()
        .where(F.col("product_category_name") != "economy")
        .withColumn("product_category_name_english", F.concat("product_category_name", F.lit("_en")))
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return _scan(spark, folder, "orders").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "O", "shipped").otherwise("delivered").alias("order_status"),
        _after(key).alias("order_purchase_timestamp"),
        F.when(key % 101 != 0, _after(key, key * 7 % 60)).alias("order_approved_at"),
        _after(key, 24 + key * 13 % 200).alias("order_delivered_carrier_date"),
        _after(key, _delivered_hours(key)).alias("order_delivered_customer_date"),
        _after(key, _estimated_hours(key)).alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """A few prices are null and the items of a few orders cost nothing."""
    key, part = F.col("l_orderkey"), F.col("l_partkey")
    price = F.when(key % 499 == 0, F.lit(0.0)).when((part + F.col("l_linenumber")) % 211 != 0, F.col("l_extendedprice"))
    return _scan(spark, folder, "lineitem").select(
        key.alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        part.alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        _after(key, (part % 6 + 4) * 24).alias("shipping_limit_date"),
        price.cast("decimal(10,2)").alias("price"),
        F.col("l_quantity").cast("decimal(10,2)").alias("freight_value"),
    )


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews without their texts.

    Every 50th order is reviewed twice; some second reviews have no score or the same time.
    """
    key, seq = F.col("o_orderkey"), F.col("seq")
    late = F.coalesce(_delivered_hours(key) > _estimated_hours(key), F.lit(False))
    first = F.when(late, key % 4 + 1).otherwise(5 - F.when(key % 11 == 0, 3).otherwise(key % 2))
    second = F.when(key % 250 != 0, 4)
    answered = _after(key, F.when(key % 100 == 0, 901).otherwise(900 + seq))
    return (
        _scan(spark, folder, "orders")
        .select("o_orderkey", F.explode(F.when(key % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("seq"))
        .select(
            F.concat_ws("-", key.cast("string"), seq.cast("string")).alias("review_id"),
            key.alias("order_id"),
            F.when(seq == 1, first).otherwise(second).cast("int").alias("review_score"),
            _after(key, 800).alias("review_creation_date"),
            answered.alias("review_answer_timestamp"),
        )
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """The text of the order's document, as found: several lines, or null without one."""
    text = _scan(spark, folder, "documents").select(
        F.col("doc_id"),
        F.concat(F.lit("\n "), F.col("source"), F.lit("\r"), F.col("lang"), F.lit("\t")).alias("review_comment_title"),
        F.concat(F.lit(" \r\n"), F.col("text"), F.lit("\u00a0\n")).alias("review_comment_message"),
    )
    rows = scores(spark, folder)
    return rows.join(text, rows.order_id == text.doc_id, "left").select(
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    )


def relations(spark: SparkSession, folder: str, texts: bool = False) -> Relations:
    """The six relations as the feature view reads them (category already filled).

    Review texts sit in another driver table; without ``texts`` that join is left out.
    """

    def filled_products() -> DataFrame:
        raw = products(spark, folder)
        return raw.withColumn("product_category_name", F.coalesce("product_category_name", F.lit("unknown")))

    return Relations(
        customers=lambda: customers(spark, folder),
        products=filled_products,
        orders=lambda: orders(spark, folder),
        reviews=lambda: (reviews if texts else scores)(spark, folder),
        order_items=lambda: order_items(spark, folder),
        category_names=lambda: category_names(spark, folder),
    )


def raw_texts(df: DataFrame) -> DataFrame:
    """Timestamps as text, the way a CSV holds them; each 89th order's times are malformed.

    Malformed means cut to the date for even keys and not a time at all for odd ones.
    """
    key = F.col("order_id")
    out = []
    for name, kind in df.dtypes:
        if kind == "timestamp_ntz":
            text = F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss")
            text = F.when(key % 89 != 0, text).when(key % 2 == 0, F.substring(text, 1, 10)).otherwise(F.lit("not a time"))
            out.append(text.alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)
