"""The six relations: column types, keys, references and length rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
TIME = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)


@dataclass(frozen=True)
class TableSpec:
    """Structure and load-time rules of one relation."""

    name: str
    columns: dict[str, T.DataType]
    primary_key: tuple[str, ...] = ()
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t) for c, t in self.columns.items()])

    @property
    def money_columns(self) -> list[str]:
        return [c for c, t in self.columns.items() if isinstance(t, T.DecimalType)]


# Table names, column names, types, keys and lengths of the data model.
# The spelling "lenght" is part of the input format.
CUSTOMERS = TableSpec(
    "customers",
    {
        "customer_id": TEXT,
        "customer_unique_id": TEXT,
        "customer_zip_code_prefix": TEXT,
        "customer_city": TEXT,
        "customer_state": TEXT,
    },
    primary_key=("customer_id",),
    max_length={"customer_zip_code_prefix": 5, "customer_state": 2},
)
PRODUCTS = TableSpec(
    "products",
    {
        "product_id": TEXT,
        "product_category_name": TEXT,
        "product_name_lenght": INT,
        "product_description_lenght": INT,
        "product_photos_qty": INT,
        "product_weight_g": INT,
        "product_length_cm": INT,
        "product_height_cm": INT,
        "product_width_cm": INT,
    },
    primary_key=("product_id",),
)
ORDERS = TableSpec(
    "orders",
    {
        "order_id": TEXT,
        "customer_id": TEXT,
        "order_status": TEXT,
        "order_purchase_timestamp": TIME,
        "order_approved_at": TIME,
        "order_delivered_carrier_date": TIME,
        "order_delivered_customer_date": TIME,
        "order_estimated_delivery_date": TIME,
    },
    primary_key=("order_id",),
    foreign_keys={"customer_id": ("customers", "customer_id")},
    max_length={"order_status": 15},
)
REVIEWS = TableSpec(
    "reviews",
    {
        "review_id": TEXT,
        "order_id": TEXT,
        "review_score": INT,
        "review_comment_title": TEXT,
        "review_comment_message": TEXT,
        "review_creation_date": TIME,
        "review_answer_timestamp": TIME,
    },
    foreign_keys={"order_id": ("orders", "order_id")},
)
ORDER_ITEMS = TableSpec(
    "order_items",
    {
        "order_id": TEXT,
        "order_item_id": INT,
        "product_id": TEXT,
        "seller_id": TEXT,
        "shipping_limit_date": TIME,
        "price": MONEY,
        "freight_value": MONEY,
    },
    primary_key=("order_id", "product_id", "order_item_id"),
    foreign_keys={"order_id": ("orders", "order_id"), "product_id": ("products", "product_id")},
)
CATEGORY_NAMES = TableSpec(
    "category_names",
    {"product_category_name": TEXT, "product_category_name_english": TEXT},
    primary_key=("product_category_name",),
)

# Load order: a referenced table comes before the tables that reference it.
TABLES: dict[str, TableSpec] = {
    spec.name: spec for spec in (CUSTOMERS, PRODUCTS, ORDERS, REVIEWS, ORDER_ITEMS, CATEGORY_NAMES)
}

class Relations:
    """The six relations; each is defined when first asked for."""

    def __init__(self, **builders: DataFrame | Callable[[], DataFrame]):
        if set(builders) != set(TABLES):
            raise ValueError(f"expected the tables {list(TABLES)}")
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._built:
            source = self._builders[table]
            self._built[table] = source if isinstance(source, DataFrame) else source()
        return self._built[table]

    customers = property(lambda self: self["customers"])
    products = property(lambda self: self["products"])
    orders = property(lambda self: self["orders"])
    reviews = property(lambda self: self["reviews"])
    order_items = property(lambda self: self["order_items"])
    category_names = property(lambda self: self["category_names"])

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(table, self[table]) for table in TABLES]


# Output of the feature view: carried keys first, then the 19 features in order.
KEY_COLUMNS = ["order_id", "review_id", "review_answer_timestamp"]
FEATURE_COLUMNS = [
    "review_score",
    "bad_score",
    "num_items",
    "total_price",
    "total_freight",
    "freight_ratio",
    "name_len",
    "desc_len",
    "category",
    "prod_photos",
    "weight_g",
    "volume_l",
    "has_missing_details",
    "delivery_days",
    "estimated_delivery_diff",
    "seller_disp_diff",
    "processing_days",
    "is_seller_late",
    "is_delivery_late",
]
DAY_COLUMNS = ["delivery_days", "estimated_delivery_diff", "seller_disp_diff", "processing_days"]
FLAG_COLUMNS = ["bad_score", "has_missing_details", "is_seller_late", "is_delivery_late"]
