"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.session import materialize


def _hang(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang neighbours of each node on the least of the node and its neighbours.

    Large star: the neighbours above the node; small star: the node and those below it.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = both.where("b < a")
    least = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
    hung = both.join(least, "a")
    if larger:
        out = hung.where("b > a").select(F.col("least").alias("a"), "b")
    else:
        out = hung.select(F.col("least").alias("a"), "b").union(least.select(F.col("least").alias("a"), F.col("a").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b); the label is the least node it is linked with.

    Large and small stars take turns until nothing moves; each round's edges are a stored table.
    A hot node is only ever summed up, or one side of a join.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = materialize(edges, "edges")
    before = mark(edges)
    while before[0]:
        edges = materialize(_hang(_hang(edges, True), False), "edges")
        now = mark(edges)
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("label"))
    return nodes.union(edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
