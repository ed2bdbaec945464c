"""Profiling of the feature view and the cleaned orders.

Each profile reads its input once or twice for all columns together; results have a
fixed number of rows whatever the input size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens import schemas
from orderlens.functions.quantiles import exact_quantiles, unpivot
from orderlens.operators import transform
from orderlens.session import small_table

DESCRIBED = [c for c in schemas.FEATURE_COLUMNS if c not in (*schemas.FLAG_COLUMNS, "category")]
BOX_COLUMNS = ["delivery_days", "estimated_delivery_diff", "processing_days"]
# Histogram columns and their numbers of bins.
HISTOGRAMS = {"total_price": 100, "log_total_price": 50, "total_freight": 100, "log_total_freight": 50}


def shape_and_types(df: DataFrame) -> DataFrame:
    """Name and type of each column with the row and column counts of the whole."""
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(t).alias("data_type"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return df.agg(F.count("*").alias("n_rows")).select(
        F.inline(F.array(*entries)), "n_rows", F.lit(len(df.columns)).alias("n_columns")
    )


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls per column in one pass."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns]
    return counts.select(F.inline(F.array(*entries)))


def duplicate_count(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Rows that repeat the key of another row; null keys count as one value."""
    per_key = df.groupBy(key).agg(F.count("*").alias("copies"))
    return per_key.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n_duplicates"))


def feature_view_grain(view: DataFrame) -> DataFrame:
    """How many orders have one, two, ... rows in the view."""
    per_order = view.groupBy("order_id").agg(F.count("*").alias("rows_per_order"))
    return per_order.groupBy("rows_per_order").agg(F.count("*").alias("n_orders"))


def describe_numeric(df: DataFrame, columns: list[str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    columns = columns or DESCRIBED
    moments = (
        unpivot(df, columns)
        .groupBy("column_name")
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("minimum"),
            F.max("value").alias("maximum"),
        )
    )
    shares = {"p25": 0.25, "p50": 0.50, "p75": 0.75}
    found = exact_quantiles(df, columns, list(shares.values()), accuracy)
    quartiles = found.groupBy("column_name").agg(
        *[F.max(F.when(F.col("share") == s, F.col("value"))).alias(n) for n, s in shares.items()]
    )
    return moments.join(quartiles, "column_name", "left").select(
        "column_name", "n", "mean", "std", "minimum", *shares, "maximum"
    )


def _shares(counts: DataFrame, keys: list[str]) -> Column:
    """Share of each counted row in its group; runs on an already aggregated table."""
    return F.col("n") / F.sum("n").over(Window.partitionBy(*keys))


def review_score_ratios(df: DataFrame) -> DataFrame:
    """Share of each score to three places, best score first."""
    counts = df.where(F.col("review_score").isNotNull()).groupBy("review_score").agg(F.count("*").alias("n"))
    return counts.select("review_score", F.bround(_shares(counts, []), 3).alias("ratio")).orderBy(
        F.desc("review_score")
    )


def bad_score_share(df: DataFrame) -> DataFrame:
    """Percentage of scores up to 3, from the rounded ratios, to one place."""
    low = F.sum(F.when(F.col("review_score") <= 3, F.col("ratio")))
    return review_score_ratios(df).agg(F.round(F.coalesce(low, F.lit(0.0)) * 100, 1).alias("bad_percent"))


def top_categories(df: DataFrame, n: int = 10) -> DataFrame:
    """The most frequent categories; equal counts in name order."""
    counts = df.groupBy("category").agg(F.count("review_score").alias("n_orders"))
    return counts.orderBy(F.desc("n_orders"), "category").limit(n)


def split_shipment_rate(df: DataFrame) -> DataFrame:
    """Share of bad scores per number of items."""
    return df.groupBy("num_items").agg(F.avg("bad_score").alias("bad_rate"))


def tail_score_mix(df: DataFrame, strict: dict[str, str] | None = None) -> DataFrame:
    """Score shares among the rows beyond each clip bound.

    ``strict`` overrides the comparison of a bound.  By default the upper seller bound
    looks at the rows below it, as the published exploration does.
    """
    compare = {
        "lower_seller": "<",
        "lower_estimated": "<",
        "upper_delivery": ">=",
        "upper_estimated": ">=",
        "upper_processing": ">=",
        "upper_seller": "<",
        **(strict or {}),
    }
    bounds = transform.clip_bounds(df).select(F.struct("*").alias("bounds")).scalar()
    cases = []
    for name, (column, _) in transform.BOUNDS.items():
        value, bound = F.col(column), F.col("bounds")[name]
        beyond = {"<": value < bound, "<=": value <= bound, ">": value > bound, ">=": value >= bound}[compare[name]]
        cases.append(F.when(beyond, F.lit(name)))
    counts = (
        df.withColumn("bounds", bounds)
        .select("review_score", F.explode(F.array_compact(F.array(*cases))).alias("bound_name"))
        .groupBy("bound_name", "review_score")
        .agg(F.count("*").alias("n"))
    )
    return counts.select("bound_name", "review_score", "n", _shares(counts, ["bound_name"]).alias("ratio"))


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns except the score.

    A pair uses the rows in which both have a value.  The co-moments of all pairs about the column means are
    matrix products of a batch's values and of what is present; tasks hand on one set of them each, which are
    summed by place, so only the matrices (columns x columns) reach the driver.  A column that does not
    vary has no correlation but with itself, and one without values none at all.
    """
    if columns is None:
        skipped = ("order_id", "review_score")
        columns = [c for c, t in df.dtypes if c not in skipped and (t in ("int", "bigint", "double") or t.startswith("decimal"))]
    numeric = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    center = np.array([v or 0.0 for v in numeric.agg(*[F.avg(c) for c in columns]).first()])
    width = len(columns)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, width, width))
        for batch in batches:
            x = np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns], dtype=np.float64)
            there = np.array([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], dtype=np.float64)
            x = np.where(there > 0, x - center[:, None], 0.0)
            total += there @ there.T, x @ there.T, x**2 @ there.T, x @ x.T
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["sums"])

    parts = numeric.mapInArrow(moments, "sums array<double>").select(F.posexplode("sums").alias("place", "value"))
    summed = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()  # 4 x columns x columns numbers
    flat = np.zeros(4 * width * width)
    for row in summed:
        flat[row["place"]] = row["value"]
    n, own, square, cross = flat.reshape(4, width, width)
    spread = n * square - own**2  # of the row's column, over the rows that the pair uses
    spread[spread <= 1e-12 * n * square] = 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        matrix = (n * cross - own * own.T) / np.sqrt(spread * spread.T)
    known = [[float(v) if np.isfinite(v) else None for v in line] for line in matrix]
    rows = [
        (a, b, (1.0 if n[i, i] else None) if i == j else known[i][j])
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return small_table(df.sparkSession, rows, "column_a string, column_b string, correlation double")


def histogram(df: DataFrame, bins: dict[str, int] | None = None) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed, empty ones included."""
    bins = bins or HISTOGRAMS
    values = unpivot(df, list(bins)).where(F.col("value").isNotNull())
    wanted = F.create_map(*[F.lit(x) for pair in bins.items() for x in pair])
    ranges = (
        values.groupBy("column_name")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
        .withColumn("bins", wanted[F.col("column_name")])
    )
    flat = F.col("low") == F.col("high")
    ranges = ranges.select(
        "column_name",
        "bins",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    ).withColumn("width", (F.col("high") - F.col("low")) / F.col("bins"))
    place = F.least(F.floor((F.col("value") - F.col("low")) / F.col("width")) + 1, F.col("bins")).cast("int")
    # Broadcast bound: one row per histogram column.
    counts = (
        values.join(F.broadcast(ranges), "column_name")
        .groupBy("column_name", place.alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    frame = ranges.select("*", F.explode(F.sequence(F.lit(1), F.col("bins"))).alias("bin"))
    return frame.join(counts, ["column_name", "bin"], "left").select(
        "column_name",
        "bin",
        (F.col("low") + (F.col("bin") - 1) * F.col("width")).alias("lower_edge"),
        (F.col("low") + F.col("bin") * F.col("width")).alias("upper_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, columns: list[str] | None = None, by: str = "review_score") -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and outliers, per group.

    A whisker never ends inside the box, even where a quartile lies beyond the last value
    within reach.  Day counts have few distinct values, so rows are collapsed to (value, copies) first
    and everything else works on those.
    """
    columns = columns or BOX_COLUMNS
    keys = ["column_name", by]
    values = unpivot(df, columns, keep=[by]).where(F.col("value").isNotNull())
    counts = values.groupBy(*keys, "value").agg(F.count("*").alias("copies"))
    quartiles = counts.groupBy(*keys).agg(F.percentile("value", [0.25, 0.5, 0.75], F.col("copies")).alias("q"))
    reach = 1.5 * (F.col("q")[2] - F.col("q")[0])
    within = F.col("value").between(F.col("q")[0] - reach, F.col("q")[2] + reach)
    return (
        counts.join(quartiles, keys)
        .groupBy(*keys)
        .agg(
            F.sum("copies").alias("n"),
            F.first("q").alias("q"),
            F.min(F.when(within, F.col("value"))).alias("whisker_low"),
            F.max(F.when(within, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(within, 0).otherwise(F.col("copies"))).alias("n_outliers"),
        )
        .select(
            *keys,
            "n",
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
            F.least("whisker_low", F.col("q")[0]).alias("whisker_low"),
            F.greatest("whisker_high", F.col("q")[2]).alias("whisker_high"),
            "n_outliers",
        )
    )
