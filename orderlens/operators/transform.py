"""Log scaling, clipping to training quantiles and smoothed category encoding."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from orderlens.functions.expressions import clamp
from orderlens.session import materialize

# Bound name -> column and quantile.
BOUNDS = {
    "lower_seller": ("seller_disp_diff", 0.01),
    "lower_estimated": ("estimated_delivery_diff", 0.01),
    "upper_delivery": ("delivery_days", 0.99),
    "upper_estimated": ("estimated_delivery_diff", 0.99),
    "upper_processing": ("processing_days", 0.99),
    "upper_seller": ("seller_disp_diff", 0.99),
}
# Clipped column -> lower and upper bound.
CLIPPED = {
    "delivery_days": (None, "upper_delivery"),
    "estimated_delivery_diff": ("lower_estimated", "upper_estimated"),
    "processing_days": (None, "upper_processing"),
    "seller_disp_diff": ("lower_seller", "upper_seller"),
}


class NotFittedError(ValueError):
    """An operator needs a fitted model and there is none."""


def add_log_columns(df: DataFrame) -> DataFrame:
    """``log1p`` of price and freight totals next to the originals."""
    return df.withColumns({f"log_{c}": F.log1p(F.col(c).cast("double")) for c in ("total_price", "total_freight")})


def log_transform(df: DataFrame) -> DataFrame:
    """Price and freight totals replaced by their ``log1p``."""
    return add_log_columns(df).drop("total_price", "total_freight")


def clip_bounds(df: DataFrame) -> DataFrame:
    """One row with the six clip bounds.

    ``percentile`` keeps one counter per distinct value; the columns are whole days, so
    their number is bounded by the calendar.
    """
    return df.agg(*[F.percentile(c, q).alias(name) for name, (c, q) in BOUNDS.items()])


def clip_quantiles(df: DataFrame) -> DataFrame:
    """The clip bounds as (bound_name, value) rows."""
    entries = [F.struct(F.lit(n).alias("bound_name"), F.col(n).alias("value")) for n in BOUNDS]
    return clip_bounds(df).select(F.inline(F.array(*entries)))


def clip_outliers(df: DataFrame, bounds: DataFrame | Row | dict) -> DataFrame:
    """Day columns limited to their bounds; ``bounds`` is a one-row table or its values."""
    if isinstance(bounds, DataFrame):
        looked_up = bounds.select(F.struct("*").alias("b")).scalar()
        df = df.withColumn("_bounds", looked_up)
        limit = {n: F.col("_bounds")[n] for n in BOUNDS}
    else:
        limit = {n: F.lit(float(bounds[n])) if bounds[n] is not None else None for n in BOUNDS}
    clipped = {
        c: clamp(F.col(c), limit[low] if low else None, limit[high] if high else None)
        for c, (low, high) in CLIPPED.items()
    }
    return df.withColumns(clipped).drop("_bounds")


def target_encoding(
    df: DataFrame, smoothing: float = 10.0, min_samples_leaf: int = 20, category: str = "category", label: str = "bad_score"
) -> DataFrame:
    """(category, n, encoded, prior): category means drawn toward the overall mean.

    Blend of Micci-Barreca (2001): weight ``1 / (1 + exp(-(n - min_samples_leaf) / smoothing))``.
    """
    stats = df.groupBy(category).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("double")).alias("total"))
    prior = stats.agg((F.sum("total") / F.sum("n")).alias("prior")).scalar()
    weight = 1.0 / (1.0 + F.exp(-(F.col("n") - min_samples_leaf) / F.lit(float(smoothing))))
    return stats.withColumn("prior", prior).select(
        category,
        "n",
        (F.col("prior") * (1.0 - weight) + F.col("total") / F.col("n") * weight).alias("encoded"),
        "prior",
    )


def apply_encoding(df: DataFrame, encoding: DataFrame, prior, category: str = "category") -> DataFrame:
    """Category replaced by its number; an unseen one gets the prior (a number or a column)."""
    fallback = prior if not isinstance(prior, (int, float)) else F.lit(float(prior))
    table = encoding.select(F.col(category).alias("_category"), F.col("encoded").alias("_encoded"))
    joined = df.join(table, F.col(category) == F.col("_category"), "left")
    return joined.select(
        *[
            F.coalesce(F.col("_encoded"), fallback).alias(category) if c == category else F.col(c)
            for c in df.columns
        ]
    )


class _Smoothing(Params):
    smoothing = Param(Params._dummy(), "smoothing", "smoothing of the category encoding", TypeConverters.toFloat)
    minSamplesLeaf = Param(
        Params._dummy(), "minSamplesLeaf", "rows at which mean and prior weigh the same", TypeConverters.toInt
    )
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label column", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(smoothing=10.0, minSamplesLeaf=20, labelCol="bad_score")


class OrderTransformer(Estimator, _Smoothing, DefaultParamsReadable, DefaultParamsWritable):
    """Learns clip bounds and the category encoding from training rows."""

    @keyword_only
    def __init__(self, *, smoothing=10.0, minSamplesLeaf=20, labelCol="bad_score"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "OrderTransformerModel":
        bounds = clip_bounds(df).first().asDict()
        encoding = target_encoding(
            df,
            self.getOrDefault(self.smoothing),
            self.getOrDefault(self.minSamplesLeaf),
            label=self.getOrDefault(self.labelCol),
        )
        encoding, prior = _settle(encoding)
        return self._copyValues(OrderTransformerModel(bounds, encoding, prior))

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


def _settle(encoding: DataFrame) -> tuple[DataFrame, float | None]:
    """Evaluate an encoding once, as a stored table whose size decides how it is joined."""
    stored = materialize(encoding, "encoding")
    row = stored.select("prior").first()
    return stored, row["prior"] if row else None


class OrderTransformerModel(Model, _Smoothing, MLReadable, MLWritable):
    """Applies logs, clipping and encoding; saved as one artifact."""

    def __init__(self, bounds: dict | None = None, encoding: DataFrame | None = None, prior: float | None = None):
        super().__init__()
        self.bounds = bounds
        self.encoding = encoding
        self.prior = prior

    def _check_fitted(self) -> None:
        if self.encoding is None or self.bounds is None:
            raise NotFittedError("fit the transformer first")

    def _transform(self, df: DataFrame) -> DataFrame:
        self._check_fitted()
        return self.encode(clip_outliers(log_transform(df), self.bounds))

    def encode(self, df: DataFrame) -> DataFrame:
        """Only the category encoding, for rows that are otherwise ready to score."""
        self._check_fitted()
        return apply_encoding(df, self.encoding, self.prior if self.prior is not None else F.lit(None).cast("double"))

    def clip(self, df: DataFrame) -> DataFrame:
        """Only the clipping, of whichever day columns the rows have."""
        self._check_fitted()
        present = {c: v for c, v in CLIPPED.items() if c in df.columns}
        limit = {n: F.lit(v) if v is None else F.lit(float(v)) for n, v in self.bounds.items()}
        return df.withColumns(
            {c: clamp(F.col(c), limit[lo] if lo else None, limit[hi] if hi else None) for c, (lo, hi) in present.items()}
        )

    def write(self) -> MLWriter:
        self._check_fitted()
        return _TransformerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TransformerReader()


class _TransformerWriter(MLWriter):
    def __init__(self, instance: OrderTransformerModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        fitted = self.instance
        state = {"bounds": fitted.bounds, "prior": fitted.prior}
        DefaultParamsWriter.saveMetadata(fitted, path, self.sparkSession, extraMetadata={"fitted": state})
        fitted.encoding.write.parquet(f"{path}/encoding")


class _TransformerReader(MLReader):
    def load(self, path: str) -> OrderTransformerModel:
        """Read a saved transformer; a missing one is a ValueError."""
        try:
            stored = self.sparkSession.read.parquet(f"{path}/encoding")
        except AnalysisException as error:
            raise ValueError(f"could not find the saved transformer {path}") from error
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = OrderTransformerModel(metadata["fitted"]["bounds"], stored, metadata["fitted"]["prior"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
