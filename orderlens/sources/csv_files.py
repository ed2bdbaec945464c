"""CSV extraction and the ordered registry of input files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schemas
from orderlens.operators import cleanup
from orderlens.sources.quoted_records import quoted_records

# Field contents that count as missing when a CSV column is read.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


@dataclass(frozen=True)
class Dataset:
    """One input file: where it lies, how it is typed, how it is cleaned."""

    spec: schemas.TableSpec
    file_name: str
    transform: Callable[[DataFrame], DataFrame]
    line_breaks_in_fields: bool = False

    @property
    def table(self) -> str:
        return self.spec.name


# File name patterns of the six inputs, in load order.
DATASETS: dict[str, Dataset] = {
    d.table: d
    for d in (
        Dataset(schemas.CUSTOMERS, "*customers_dataset.csv", cleanup.clean_customers),
        Dataset(schemas.PRODUCTS, "*products_dataset.csv", cleanup.clean_products),
        Dataset(schemas.ORDERS, "*orders_dataset.csv", cleanup.clean_orders),
        Dataset(schemas.REVIEWS, "*order_reviews_dataset.csv", cleanup.clean_reviews, line_breaks_in_fields=True),
        Dataset(schemas.ORDER_ITEMS, "*order_items_dataset.csv", cleanup.clean_order_items),
        Dataset(schemas.CATEGORY_NAMES, "*category_name_translation.csv", cleanup.clean_category_names),
    )
}


def _typed(column: Column, data_type: T.DataType) -> Column:
    """Text to its column type; a malformed number fails the job instead of vanishing."""
    present = F.when(~column.isin(MISSING), column)
    if isinstance(data_type, T.IntegerType):
        number = present.try_cast("decimal(20,4)")
        whole = number.try_cast("int")
        broken = present.isNotNull() & ~F.coalesce(whole.cast("decimal(20,4)") == number, F.lit(False))
        return F.when(
            broken, F.raise_error(F.concat(F.lit("not a whole number: "), present)).cast("int")
        ).otherwise(whole)
    if isinstance(data_type, T.NumericType):
        number = present.try_cast(data_type)
        return F.when(
            present.isNotNull() & number.isNull(),
            F.raise_error(F.concat(F.lit("not a number: "), present)).cast(data_type),
        ).otherwise(number)
    return present


def csv_scan(
    spark: SparkSession,
    path: str,
    columns: dict[str, T.DataType] | None = None,
    line_breaks_in_fields: bool = False,
    infer: bool = False,
) -> DataFrame:
    """Read a headed CSV by column name; times stay text until the cleanup step.

    ``columns`` names and types the result.  With ``infer`` it only overrides the types
    found by one more pass over the file.  All files of the path must have the same header in
    the same order, and every row as many fields as the header; anything else fails.  Fields that hold
    line breaks take two scans (:mod:`orderlens.sources.quoted_records`), so they are only looked for where
    that is asked for.  Splits are read by different tasks either way.
    """

    def reader():
        return (
            spark.read.option("header", True)
            .option("multiLine", line_breaks_in_fields)
            .option("quote", '"')
            .option("escape", '"')
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .option("columnPruning", False)
        )

    raw = quoted_records(spark, path) if line_breaks_in_fields else reader().csv(path)
    by_name = {name.lstrip("\ufeff"): name for name in raw.columns}
    wanted = dict(columns or {})
    absent = [c for c in wanted if c not in by_name]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")
    if infer or not wanted:
        # types are found by Spark's own reader, which reads a file with line breaks in fields by one task
        found = reader().option("inferSchema", infer).csv(path).schema
        numbers = {n: f.dataType for n, f in zip(by_name, found) if isinstance(f.dataType, T.NumericType)}
        wanted = {n: wanted.get(n, numbers.get(n, T.StringType())) for n in by_name}
    return raw.select(*[_typed(F.col(f"`{by_name[c]}`"), t).alias(c) for c, t in wanted.items()])


def scan_dataset(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Scan one registered input below ``folder``."""
    dataset = DATASETS[table]
    path = f"{folder.rstrip('/')}/{dataset.file_name}"
    return csv_scan(spark, path, dataset.spec.columns, dataset.line_breaks_in_fields)
