"""Which features drive the risk, and in which direction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.quantiles import unpivot
from orderlens.functions.ranks import exact_rank
from orderlens.operators import evaluate, models
from orderlens.operators.sampling import SEED


def permutation_importance(df: DataFrame, model, features: list[str], seed: int = SEED) -> DataFrame:
    """(feature, f1, f1_drop): F1 lost when one feature is taken from a random other row.

    Rows are paired by two seeded ranks, a join on unique keys; each pair then yields one
    scored copy per feature, and the copies are counted at once, never stored.
    """
    rows = exact_rank(df.select("order_id", models.LABEL, *features), "order_id", seed, rank_name="_place")
    donors = exact_rank(df.select("order_id", *features), "order_id", seed + 1, rank_name="_place")
    donors = donors.select("_place", F.struct(*features).alias("_donor"))
    paired = rows.join(donors, "_place")
    copies = [_copy("", features, None)] + [_copy(f, features, f) for f in features]
    scored = models.predict(
        paired.select(models.LABEL, F.explode(F.array(*copies)).alias("_c")).select(models.LABEL, "_c.*"),
        model,
        features,
    )
    y, p = F.col(models.LABEL), F.col("prediction")
    cells = scored.groupBy("_shuffled").agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )
    scores = cells.select("_shuffled", evaluate.f1_of(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))
    return scores.groupBy().agg(
        F.max(F.when(F.col("_shuffled") == "", F.col("f1"))).alias("base"),
        F.collect_list(F.when(F.col("_shuffled") != "", F.struct(F.col("_shuffled").alias("feature"), "f1"))).alias("s"),
    ).select("base", F.inline("s")).select("feature", "f1", (F.col("base") - F.col("f1")).alias("f1_drop"))


def _copy(name: str, features: list[str], shuffled: str | None):
    values = [
        (F.col("_donor")[f] if f == shuffled else F.col(f)).cast("double").alias(f) for f in features
    ]
    return F.struct(F.lit(name).alias("_shuffled"), *values)


def impact_by_decile(df: DataFrame, model, features: list[str]) -> DataFrame:
    """(feature, decile, n, mean_value, mean_probability) by tenths of each feature's values.

    Decile edges come from a sketch over all rows; equal values share a decile.
    """
    tenths = [i / 10 for i in range(1, 10)]
    scored = models.predict(df.select(*features), model, features).select(*features, "probability")
    values = unpivot(scored, features, name="feature", keep=["probability"])
    edges = (
        unpivot(df, features, name="feature")
        .groupBy("feature")
        .agg(F.percentile_approx("value", tenths, 10_000).alias("edges"))
    )
    # Broadcast bound: one row per feature.
    placed = values.join(F.broadcast(edges), "feature").withColumn(
        "decile", F.size(F.filter("edges", lambda e: e < F.col("value"))) + 1
    )
    return placed.groupBy("feature", "decile").agg(
        F.count("*").alias("n"),
        F.avg("value").alias("mean_value"),
        F.avg("probability").alias("mean_probability"),
    )
