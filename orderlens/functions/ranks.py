"""Seeded, exact ranks without a one-task window.

Rows are ordered by an md5 of seed and id.  The first hex digits of the hash cut each
stratum into equal buckets, so counting per bucket gives the offset of a bucket and only
rows of one bucket have to meet in a task.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH, BUCKET = "_hash", "_bucket"
ROWS_OF_A_BUCKET = 100_000  # about, as hashes of distinct ids are even
LEAST_DIGITS = 3


def digits_for(n: int) -> int:
    """Hex digits that leave a bucket at most about ``ROWS_OF_A_BUCKET`` of ``n`` rows."""
    digits = LEAST_DIGITS
    while n > ROWS_OF_A_BUCKET * 16**digits:
        digits += 1
    return digits


def seeded_hash(id_column: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_column).cast("string")))


def _hashed(df: DataFrame, id_column: str, seed: int, digits: int) -> DataFrame:
    hashed = df.withColumn(HASH, seeded_hash(id_column, seed))
    return hashed.withColumn(BUCKET, F.substring(HASH, 1, digits))


def _bucket_offsets(hashed: DataFrame, strata: list[str]) -> DataFrame:
    """Rows per bucket and rows before it; at most 16**digits rows per stratum."""
    sizes = hashed.groupBy(*strata, BUCKET).agg(F.count("*").alias("_size"))
    ordered = Window.partitionBy(*strata).orderBy(BUCKET)
    whole = Window.partitionBy(*strata)
    return sizes.select(
        *strata,
        BUCKET,
        "_size",
        (F.sum("_size").over(ordered) - F.col("_size")).alias("_before"),
        F.sum("_size").over(whole).alias("_total"),
    )


def exact_rank(
    df: DataFrame, id_column: str, seed: int, strata: list[str] = (), rank_name: str = "rank", digits: int | None = None
) -> DataFrame:
    """Add the 1-based rank of each row in its stratum, by (md5(seed|id), id).

    ``strata`` must have few values (a label); ids must be unique.  The number of buckets follows the
    rows, which are counted, so the rows that meet in one task do not grow with them.
    """
    digits = digits or digits_for(df.count())
    keys = list(strata) or ["_all"]
    hashed = _hashed(df if strata else df.withColumn("_all", F.lit(0)), id_column, seed, digits)
    offsets = _bucket_offsets(hashed, keys).select(*keys, BUCKET, "_before")
    in_bucket = Window.partitionBy(*keys, BUCKET).orderBy(HASH, id_column)
    # Broadcast bound: 16**3 rows per stratum.  More buckets are joined where the window has put their rows.
    offsets = F.broadcast(offsets) if digits <= LEAST_DIGITS else offsets
    return (
        hashed.withColumn("_row", F.row_number().over(in_bucket))
        .join(offsets, [*keys, BUCKET])
        .withColumn(rank_name, F.col("_before") + F.col("_row"))
        .select(*df.columns, rank_name)
    )


def take_share(
    df: DataFrame,
    share: float | str,
    id_column: str,
    seed: int,
    strata: list[str] = (),
    flag_name: str = "taken",
    digits: int | None = None,
    whole: Callable[[Column], Column] = F.floor,
) -> DataFrame:
    """Flag the first ``whole(share * n)`` rows of every stratum in hash order.

    Only the one bucket of a stratum that holds the cut is ranked; for all other rows
    the flag is a comparison with the cut, so the input itself is never shuffled.
    Ids must be unique.  The number of buckets follows the rows, as in ``exact_rank``.
    """
    digits = digits or digits_for(df.count())
    keys = list(strata) or ["_all"]
    hashed = _hashed(df if strata else df.withColumn("_all", F.lit(0)), id_column, seed, digits)
    wanted = whole(F.col("_total") * F.lit(Decimal(str(share))))
    boundary = (
        _bucket_offsets(hashed, keys)
        .withColumn("_wanted", wanted)
        .where((F.col("_before") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_before") + F.col("_size")))
        .select(*keys, BUCKET, (F.col("_wanted") - F.col("_before")).alias("_need"))
    )
    in_bucket = Window.partitionBy(*keys, BUCKET).orderBy(HASH, id_column)
    # Broadcast bound of both joins: one row per stratum.
    cut = (
        hashed.select(*keys, BUCKET, HASH, id_column)
        .join(F.broadcast(boundary), [*keys, BUCKET])
        .withColumn("_row", F.row_number().over(in_bucket))
        .where(F.col("_row") == F.col("_need"))
        .select(*keys, F.struct(F.col(HASH), F.col(id_column)).alias("_cut"))
    )
    taken = F.coalesce(F.struct(F.col(HASH), F.col(id_column)) <= F.col("_cut"), F.lit(False))
    return (
        hashed.join(F.broadcast(cut), keys, "left").withColumn(flag_name, taken).select(*df.columns, flag_name)
    )
