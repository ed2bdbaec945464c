"""Class weights and classification metrics.

Labels are counted on the executors into a handful of cells; every metric is arithmetic
on those cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.expressions import hundredths

CELLS = ["tn", "fp", "fn", "tp"]


def class_weight(df: DataFrame, label: str = "bad_score") -> DataFrame:
    """One row: negatives, positives and their ratio (null without positives)."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("n_negative"), F.count_if(F.col(label) == 1).alias("n_positive")
    )
    return counts.withColumn("pos_weight", F.try_divide(F.col("n_negative"), F.col("n_positive")))


def balanced_weights(df: DataFrame, label: str = "bad_score") -> DataFrame:
    """Weight ``n / (k * n_c)`` of each of the k classes."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    whole = Window.partitionBy()  # over one row per class
    return counts.select(
        label, "n", (F.sum("n").over(whole) / (F.count("*").over(whole) * F.col("n"))).alias("weight")
    )


def confusion_cells(df: DataFrame, label: str = "bad_score", prediction: str = "prediction") -> DataFrame:
    """One row with the four cells."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def confusion_matrix(df: DataFrame, label: str = "bad_score", prediction: str = "prediction") -> DataFrame:
    """(actual, predicted_0, predicted_1); absent combinations count 0."""
    rows = F.array(
        F.struct(F.lit(0).alias("actual"), F.col("tn").alias("predicted_0"), F.col("fp").alias("predicted_1")),
        F.struct(F.lit(1).alias("actual"), F.col("fn").alias("predicted_0"), F.col("tp").alias("predicted_1")),
    )
    return confusion_cells(df, label, prediction).select(F.inline(rows))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def precision_of(tp: Column, fp: Column) -> Column:
    return _ratio(tp, tp + fp)


def recall_of(tp: Column, fn: Column) -> Column:
    return _ratio(tp, tp + fn)


def f1_of(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(2 * tp, 2 * tp + fp + fn)


def classification_report(df: DataFrame, label: str = "bad_score", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted means."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    n0, n1, n = tn + fp, fn + tp, tn + fp + fn + tp
    per_class = {
        "precision": (precision_of(tn, fn), precision_of(tp, fp)),
        "recall": (recall_of(tn, fp), recall_of(tp, fn)),
        "f1": (f1_of(tn, fn, fp), f1_of(tp, fp, fn)),
    }

    def row(name: str, values: dict[str, Column], support: Column) -> Column:
        parts = [values[m].cast("double").alias(m) for m in per_class]
        return F.struct(F.lit(name).alias("class"), *parts, support.alias("support"))

    accuracy = _ratio(tn + tp, n)
    none = F.lit(None).cast("double")
    rows = F.array(
        row("0", {m: v[0] for m, v in per_class.items()}, n0),
        row("1", {m: v[1] for m, v in per_class.items()}, n1),
        row("accuracy", {"precision": none, "recall": none, "f1": accuracy}, n),
        row("macro avg", {m: (v[0] + v[1]) / 2 for m, v in per_class.items()}, n),
        row("weighted avg", {m: _ratio(v[0] * n0 + v[1] * n1, n) for m, v in per_class.items()}, n),
    )
    return confusion_cells(df, label, prediction).select(F.inline(rows))


def f1(df: DataFrame, label: str = "bad_score", prediction: str = "prediction") -> DataFrame:
    """One row: F1 of the positive class; 0 when undefined."""
    cells = confusion_cells(df, label, prediction)
    return cells.select(f1_of(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))


def threshold_sweep(
    df: DataFrame, label: str = "bad_score", probability: str = "probability", first: int = 10, last: int = 90
) -> DataFrame:
    """Confusion cells and metrics for each threshold in hundredths.

    Rows without a probability have no decision and are left out.  Rows collapse to 101 probability buckets in one pass; each threshold is then a running
    sum over the buckets from the top.
    """
    bucket = F.greatest(F.lit(0), F.least(F.lit(100), hundredths(F.col(probability))))
    counts = df.where(F.col(probability).isNotNull()).groupBy(bucket.alias("bucket")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    steps = df.sparkSession.range(101).select(F.col("id").cast("int").alias("bucket"))
    down, whole = Window.orderBy(F.desc("bucket")), Window.partitionBy()  # over 101 rows
    pos, neg = F.coalesce("pos", F.lit(0)), F.coalesce("neg", F.lit(0))
    cells = steps.join(counts, "bucket", "left").select(
        F.col("bucket").alias("threshold"),
        F.sum(pos).over(down).alias("tp"),
        F.sum(neg).over(down).alias("fp"),
        F.sum(pos).over(whole).alias("n_pos"),
        F.sum(neg).over(whole).alias("n_neg"),
    )
    cells = cells.select(
        "threshold", "tp", "fp", (F.col("n_pos") - F.col("tp")).alias("fn"), (F.col("n_neg") - F.col("fp")).alias("tn")
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cells.where(F.col("threshold").between(first, last)).select(
        "*",
        precision_of(tp, fp).alias("precision"),
        recall_of(tp, fn).alias("recall"),
        f1_of(tp, fp, fn).alias("f1"),
    )
