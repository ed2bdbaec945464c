"""Column expressions shared by the operators; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space that str.strip() removes, as a character class.
SPACES = (
    "[\\t-\\r\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)
TIMESTAMP_SHAPE = r"\A\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\z"


def tidy_text(column: Column) -> Column:
    """Null to empty, each line break to one space, outer white space removed."""
    one_line = F.regexp_replace(F.coalesce(column, F.lit("")), "[\\n\\r]", " ")
    return F.regexp_replace(one_line, f"^{SPACES}+|{SPACES}+$", "")


def parse_timestamp(column: Column) -> Column:
    """``yyyy-M-d H:m:s``, one or two digits each; anything else, also with a line break after it, is null."""
    text = column.cast("string")
    return F.when(text.rlike(TIMESTAMP_SHAPE), text.try_cast("timestamp_ntz"))


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days of ``later - earlier``, truncated toward zero."""
    return F.extract(F.lit("DAY"), later - earlier).cast("int")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def is_bad_score(review_score: Column) -> Column:
    return flag(review_score <= 3)


def freight_ratio(total_freight: Column, total_price: Column) -> Column:
    """Exact decimal ratio to four places, half away from zero; a zero price gives null."""
    return F.round(F.try_divide(total_freight, total_price), 4)


def volume_litres(length_cm: Column, height_cm: Column, width_cm: Column) -> Column:
    """Litres to two places; 0 when a dimension is missing."""
    cubic_cm = length_cm.cast("bigint") * height_cm.cast("bigint") * width_cm.cast("bigint")
    litres = F.round(cubic_cm.cast("decimal(20,0)") / F.lit(1000).cast("decimal(4,0)"), 2)
    return F.coalesce(litres, F.lit(0).cast("decimal(22,2)")).cast("decimal(22,2)")


def clamp(column: Column, lower: Column | None = None, upper: Column | None = None) -> Column:
    """Limit a value to its bounds; null stays null (plain least/greatest would return the bound)."""
    value = column.cast("double")
    if lower is not None:
        value = F.greatest(value, lower)
    if upper is not None:
        value = F.least(value, upper)
    return F.when(column.isNotNull(), value)


def hundredths(probability: Column) -> Column:
    """Largest t with ``t / 100 <= probability``, exact for every threshold written as t / 100.

    ``floor(p * 100)`` alone is wrong for 0.29, whose product is 28.999...
    """
    guess = F.floor(probability * 100.0)
    return (
        F.when(probability >= (guess + 1) / F.lit(100.0), guess + 1)
        .when(probability < guess / F.lit(100.0), guess - 1)
        .otherwise(guess)
        .cast("int")
    )
