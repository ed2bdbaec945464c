"""What-if scoring of whole tables of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators import models
from orderlens.operators.transform import OrderTransformerModel

# The seven columns a scoring row has.
SCORING_COLUMNS = [
    "num_items", "desc_len", "category", "weight_g", "delivery_days", "estimated_delivery_diff", "log_total_freight",
]

# The categories that may be chosen for an order.
CATEGORIES = [
    "agro_industry_and_commerce", "air_conditioning", "art", "arts_and_craftmanship", "audio", "auto", "baby",
    "bed_bath_table", "books_general_interest", "books_imported", "books_technical", "cds_dvds_musicals",
    "christmas_supplies", "cine_photo", "computers", "computers_accessories", "consoles_games",
    "construction_tools_construction", "construction_tools_lights", "construction_tools_safety", "cool_stuff",
    "costruction_tools_garden", "costruction_tools_tools", "diapers_and_hygiene", "drinks", "dvds_blu_ray",
    "electronics", "fashio_female_clothing", "fashion_bags_accessories", "fashion_childrens_clothes",
    "fashion_male_clothing", "fashion_shoes", "fashion_sport", "fashion_underwear_beach", "fixed_telephony",
    "flowers", "food", "food_drink", "furniture_bedroom", "furniture_decor", "furniture_living_room",
    "furniture_mattress_and_upholstery", "garden_tools", "health_beauty", "home_appliances", "home_appliances_2",
    "home_comfort_2", "home_confort", "home_construction", "housewares", "industry_commerce_and_business",
    "kitchen_dining_laundry_garden_furniture", "la_cuisine", "luggage_accessories", "market_place", "music",
    "musical_instruments", "office_furniture", "party_supplies", "perfumery", "pet_shop", "security_and_services",
    "signaling_and_security", "small_appliances", "small_appliances_home_oven_and_coffee", "sports_leisure",
    "stationery", "tablets_printing_image", "telephony", "toys", "watches_gifts", "unknown",
]

# Limits of the inputs and of the threshold (in hundredths).
LIMITS = {
    "num_items": (1, None),
    "desc_len": (0, None),
    "weight_kg": (0.05, None),
    "delivery_days": (1, 50),
    "estimated_delivery_diff": (-30, 30),
    "freight_value": (0.0, None),
}
THRESHOLD_LIMITS = (10, 90)


def check_threshold(threshold: float) -> float:
    low, high = THRESHOLD_LIMITS
    if not low / 100 <= threshold <= high / 100:
        raise ValueError(f"threshold must lie in {low / 100:.2f} .. {high / 100:.2f}")
    return threshold


def scoring_features(df: DataFrame) -> DataFrame:
    """Inputs in kilograms and currency to the seven scoring columns; ids and labels are kept."""
    carried = [c for c in df.columns if c in models.NOT_FEATURES]
    derived = {
        "weight_g": F.col("weight_kg").cast("double") * 1000,
        "log_total_freight": F.log1p(F.col("freight_value").cast("double")),
    }
    return df.select(*carried, *[derived.get(c, F.col(c)).alias(c) for c in SCORING_COLUMNS])


def input_rules(df: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """(rule, n_bad): rows outside each input's limits, in one pass; a missing value is outside."""
    checks = {}
    for column, (low, high) in LIMITS.items():
        inside = F.col(column) >= low
        if high is not None:
            inside = inside & (F.col(column) <= high)
        name = f"{column} >= {low}" if high is None else f"{column} in {low} .. {high}"
        checks[name] = inside
    checks["category known"] = F.col("category").isin(categories or CATEGORIES)
    counts = df.agg(
        *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"c{i}") for i, ok in enumerate(checks.values())]
    )
    rows = [F.struct(F.lit(n).alias("rule"), F.col(f"c{i}").alias("n_bad")) for i, n in enumerate(checks)]
    return counts.select(F.inline(F.array(*rows)))


def score_orders(
    df: DataFrame, transformer: OrderTransformerModel, model, features: list[str] = None, clip: bool = False
) -> DataFrame:
    """Encode the category and add the probability of a bad score.

    Serving does not clip unless asked to; training does.
    """
    rows = transformer.clip(df) if clip else df
    scored = models.predict(transformer.encode(rows), model, features or SCORING_COLUMNS)
    return scored.drop("prediction")


def risk_decision(df: DataFrame, threshold: float = 0.5, probability: str = "probability") -> DataFrame:
    """Level, advice and percentage; a probability equal to the threshold is high risk.

    All three are null without a probability.  A percentage midway between two tenths goes to the
    even one, as those of binary fractions can be.
    """
    high = F.col(probability) >= check_threshold(threshold)
    percent = F.col(probability) * 100
    midway = F.pmod(percent * 2, F.lit(1.0)) == 0.5
    shown = F.format_string("%.1f%%", F.when(midway, F.bround(percent, 1)).otherwise(percent))
    return df.withColumns(
        {
            "risk_percent": F.when(percent.isNotNull(), shown),
            "risk_level": F.when(high, "High Risk").when(~high, "Safe"),
            "advice": F.when(high, "contact the customer").when(~high, "no intervention"),
        }
    )


def risk_factors(df: DataFrame) -> DataFrame:
    """Array of the reasons that apply to each order."""
    late = F.col("estimated_delivery_diff")
    reasons = F.array(
        F.when(F.col("num_items") >= 2, F.lit("multiple items")),
        F.when(late > 0, F.format_string("delayed by %d day(s)", late)),
    )
    return df.withColumn("risk_factors", F.array_compact(reasons))
