"""Exact places of rows in their group, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import materialize


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` stored, with a distinct number ``rid`` for each; it breaks ties between equal rows."""
    return materialize(rows.withColumn("rid", F.monotonically_increasing_id()), name)


def ranked(rows: DataFrame, group: str, order: list[Column | str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0, within the group by ``order``) and ``n`` (rows of the group).

    Rows are dealt to ranges of (group, order), sorted there and stored with their place in the
    range; a group's rows before a range are then a sum over one row per range and group.  The order
    must be total, so that a group of equal rows can lie in several ranges.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
    placed = materialize(sorted_rows.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33).alias("part")  # the number of the range; the lower bits count its rows
    counts = placed.groupBy(part, group).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "part",
        group,
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy(group)).alias("n"),
    )
    # stored, so that its size is known when the join is planned
    offsets = materialize(offsets, f"{name}-offsets")
    found = placed.withColumn("part", part).join(offsets, ["part", group])
    return found.withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")
