"""Merkle manifest of a dataset: a hash tree per group of rows, and one over the groups.

Every level is one pass of windows over runs of ``fanout`` neighbours: lag and lead columns at fixed
offsets, masked by the slot in the run and the length of the run, are the siblings of a node, and the
row in the first slot hashes its run to the parent.  Levels shrink by the fanout.  On the way back each
level is joined with the one above, so a leaf ends with the siblings of all its ancestors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.positions import numbered, ranked
from orderlens.session import materialize

FANOUT = 8
PATH = "array<struct<left:binary,right:binary>>"


def row_hash(columns: list[Column]) -> Column:
    """Hex sha256 of the values in a row: ``-`` for a null, else byte length, ``:`` and the value."""
    values = [c.cast("string") for c in columns]
    pieces = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*pieces), 256)


def join_hash(digests: Column) -> Column:
    """Hex sha256 of the hex text of concatenated binary digests."""
    return F.sha2(F.lower(F.hex(digests)), 256)


def fold(leaf: Column, path: Column) -> Column:
    """Hex root that a hex leaf and the siblings of its path lead to."""
    up = F.aggregate(
        path, F.unhex(leaf), lambda h, s: F.unhex(join_hash(F.concat(s["left"], h, s["right"])))
    )
    return F.lower(F.hex(up))


def proof_digest(path: Column) -> Column:
    """Hex sha256 of all siblings of a path, lowest level first, left to right."""
    empty = F.lit(bytearray())
    return join_hash(F.aggregate(path, empty, lambda p, s: F.concat(p, s["left"], s["right"])))


def _siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """The nodes of a level with ``run``, ``slot`` and the joined digests left and right of them in their run."""
    placed = nodes.withColumn("run", F.expr(f"pos div {fanout}")).withColumn("slot", F.col("pos") % fanout)
    length = F.least(F.lit(fanout), F.col("n") - F.col("run") * fanout)
    run = Window.partitionBy("grp", "run").orderBy("pos")
    lags = [F.when(F.col("slot") >= k, F.lag("h", k).over(run)) for k in range(fanout - 1, 0, -1)]
    leads = [F.when(F.col("slot") + k < length, F.lead("h", k).over(run)) for k in range(1, fanout)]
    empty = F.lit(bytearray())
    return placed.withColumns(
        {
            "left": F.concat(*[F.coalesce(h, empty) for h in lags]),
            "right": F.concat(*[F.coalesce(h, empty) for h in leads]),
        }
    )


def _levels(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """The nodes (grp, pos, n, h) and all levels above, the last with one node per group."""
    levels = [nodes]
    top = nodes.agg(F.max("n")).first()[0] or 1
    while len(levels) == 1 or top > 1:
        first = _siblings(levels[-1].select("grp", "pos", "n", "h"), fanout).where("slot = 0")
        parent = F.when(F.col("n") == 1, F.col("h")).otherwise(F.unhex(join_hash(F.concat("h", "right"))))
        above = first.select("grp", F.col("run").alias("pos"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
                             parent.alias("h"))
        levels.append(materialize(above, "merkle-level"))
        top = -(-top // fanout)
    return levels


def _descend(levels: list[DataFrame], paths: DataFrame, fanout: int) -> DataFrame:
    """The lowest level with ``path`` and what else ``paths`` (grp, pos, path, ...) holds for the highest."""
    for level in reversed(levels[:-1]):
        own = F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.array().cast(PATH))
        found = _siblings(level, fanout).join(paths.withColumnRenamed("pos", "run"), ["grp", "run"])
        paths = found.withColumn("path", F.concat(own, "path")).drop("left", "right", "run", "slot", "n", "h")
    return paths


def merkle_manifest(
    docs: DataFrame,
    columns: list[str],
    group: str,
    order: str,
    fanout: int = FANOUT,
    carried: dict[str, Column] | None = None,
) -> DataFrame:
    """(order column, leaf, subroot, root, path, carried columns) of every row.

    A leaf is the hash of ``columns``.  Rows of one ``group`` (a null is a group too, the first one)
    form a tree in ascending ``order`` (nulls first; equal ones by leaf), groups in bytewise order of
    their text form the tree over the subroots.  ``path`` holds the joined binary digests left and
    right of each ancestor in its run, lowest level first, without levels of a single node.  ``carried``
    are expressions over ``docs`` that the result keeps.  Repeated rows are leaves of their own; an
    empty table gives no rows; columns that are not named, whatever they are called, are ignored.
    """
    carried = carried or {}
    tag = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(
        tag.alias("grp"),
        F.col(order).alias("key"),
        F.unhex(row_hash([F.col(c) for c in columns])).alias("h"),
        *[c.alias(f"carried_{name}") for name, c in carried.items()],
    )
    leaves = ranked(numbered(rows, "merkle-rows"), "grp", [F.asc_nulls_first("key"), "h", "rid"], "merkle-leaves")
    levels = _levels(leaves, fanout)

    subroots = levels[-1].select(F.lit("all").alias("grp"), F.col("grp").alias("of"), "h")
    upper = _levels(ranked(subroots, "grp", ["of"], "merkle-groups"), fanout)
    top = upper[-1].select("grp", "pos", F.array().cast(PATH).alias("path"), F.col("h").alias("root"))
    lowest = upper[0].withColumn("subroot", F.col("h"))
    groups = _descend([lowest, *upper[1:]], top, fanout)
    groups = materialize(groups.select(F.col("of").alias("grp"), F.lit(0).cast("long").alias("pos"), "path", "root",
                                       "subroot"), "merkle-paths")

    lowest = leaves.withColumn("leaf", F.col("h"))
    found = _descend([lowest, *levels[1:]], groups, fanout)
    return found.select(
        F.col("key").alias(order),
        *[F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")],
        "path",
        *[F.col(f"carried_{name}").alias(name) for name in carried],
    )
