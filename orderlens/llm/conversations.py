"""Repair of conversations whose turns were dropped, emptied, cut, repeated or given the wrong role.

Rows are numbered within their conversation and dealt to blocks of at most ``BLOCK`` rows, which carry a
small number for each row and no text.  A block is divided and conquered in one task
(:mod:`orderlens.llm.hirschberg`).  A conversation of more blocks becomes a tree: a block, and then a
stretch of blocks, is summed up as one step, the highest stretch is crossed first, and every stretch
learns the states that it begins and ends in from the one above.  The edits go back to the texts by
row number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm import hirschberg as H
from orderlens.llm.positions import numbered, ranked
from orderlens.session import materialize

BLOCK = 4096  # rows of a block, and blocks of a stretch; memory of a task is in proportion, results don't depend on it
WHITE = " \t\n\v\f\r"
NAMES = {"u": "user", "a": "assistant"}
SOLVED = """c string, blk long, cost long, audit string, illegal long, head string, tail string,
edits array<struct<rid:long,pos:long,before:string,role:string,after:string>>"""


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with every twentieth turn each dropped, emptied, cut, repeated or said by the user.

    Nulls count as one space.  crc32 of ``conv_id:turn`` decides; a repeated row differs in no column.
    """

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    role = F.when(kind == 4, "user").otherwise(known("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    kept = rows.where(kind != 0)
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_")).drop("_")


def key(conv_id: Column) -> Column:
    """Text that names a conversation; rows without an id are one conversation."""
    return F.coalesce(conv_id.cast("string"), F.lit(" "))


@dataclass
class Repair:
    """``report``: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), one row for each
    conversation.  ``turns``: (c, conv_id, pos, part, role, text), the repaired rows; ``pos, part`` order them."""

    report: DataFrame
    turns: DataFrame


def repair(rows: DataFrame, block: int = BLOCK) -> Repair:
    """Cheapest edits of every conversation that make its roles read ``(s?(ua)+)?``.

    Rows are taken by turn (nulls first; equal turns by role, then by sha256 of the text).  A null role
    or text is one space; rows without ``conv_id`` are one conversation; repeated rows are duplicates; an
    empty table gives no rows; columns of other names are ignored.  Equally cheap edits: the
    audit that is least by ASCII.
    """
    known = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    stored = rows.select(key(F.col("conv_id")).alias("c"), "conv_id", "turn", *known)
    stored = numbered(stored.withColumn("digest", F.unhex(F.sha2("text", 256))), "turns")
    stripped = F.rtrim("text", F.lit(WHITE))
    narrow = stored.select(
        "c",
        "turn",
        "role",
        "digest",
        "rid",
        (stripped == "").alias("blank"),
        (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    placed = ranked(narrow, "c", [F.asc_nulls_first("turn"), "role", "digest", "rid"], "turns-placed")
    marked = _faults(placed)
    blocks = _blocks(marked, block)
    solved = _solve(blocks, block)
    return Repair(_report(stored, marked, solved), _turns(stored, solved))


def _faults(placed: DataFrame) -> DataFrame:
    """Adds ``fault`` (blank, duplicate, truncated or null) and ``code``, what the edits of a row depend on.

    The first of several equal rows is found by an aggregate, not a window, as a third of all rows may be equal.
    """
    same = placed.where("not blank").groupBy("c", "role", "digest")
    several = same.agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    found = placed.join(several, ["c", "role", "digest"], "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate").when(F.col("cut"), "truncated")
    initial = F.substring("role", 1, 1)
    role = F.coalesce(*[F.when(initial == r, i) for i, r in enumerate(H.ROLES[:-1])], F.lit(len(H.ROLES) - 1))
    harm = F.when(F.col("fault").isNull(), H.SOUND).when(F.col("fault") == "truncated", H.TRUNCATED).otherwise(H.LOST)
    found = found.withColumn("fault", fault).withColumn("code", role * 3 + harm)
    return materialize(found.select("c", "rid", "turn", "pos", "n", "fault", "code"), "turns-marked")


def _blocks(marked: DataFrame, size: int) -> DataFrame:
    """(c, blk, n, rids, codes) with at most ``size`` rows of one conversation, in order; n counts its blocks."""
    group = marked.groupBy("c", F.expr(f"pos div {size}").alias("blk"))
    rows = group.agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "rid", "code"))).alias("rows"))
    count = F.expr(f"(n + {size - 1}) div {size}").alias("n")
    rids, codes = F.col("rows.rid").alias("rids"), F.col("rows.code").alias("codes")
    return materialize(rows.select("c", "blk", count, rids, codes), "turns-blocks")


def _flat(step: H.Step) -> list[int]:
    return [x for costs, ranks in step for x in (*costs, *ranks)]


def _steps(flat: list[int]) -> list[H.Step]:
    vectors = [(tuple(flat[i : i + 4]), tuple(flat[i + 4 : i + 8])) for i in range(0, len(flat), 8)]
    return [tuple(vectors[i : i + 4]) for i in range(0, len(vectors), 4)]


def _solve(blocks: DataFrame, size: int) -> DataFrame:
    """The edits of every block; see ``SOLVED``."""
    top = blocks.agg(F.max("n")).first()[0] or 1
    levels = []
    below = None
    while top > 1:
        below = materialize(_stretches(blocks, None) if below is None else _stretches(below, size), "turns-steps")
        levels.append(below)
        if len(levels) > 1:
            top = -(-top // size)
    asked = None  # (c, blk, begin, finish) of the nodes of a level; nothing yet: each is a whole conversation
    for level in reversed(levels[:-1]):
        asked = materialize(_cross(level, asked, size), "turns-crossings")
    joined = blocks.withColumns({"begin": F.lit(0), "finish": F.lit(None).cast("int")})
    if asked is not None:
        joined = blocks.join(asked, ["c", "blk"])
    last = F.col("blk") == F.col("n") - 1
    rows = joined.select("c", "blk", "begin", "finish", last.alias("last"), "rids", "codes", F.lit(size).alias("size"))
    return materialize(rows.mapInArrow(_solve_blocks, SOLVED), "turns-solved")


def _stretches(nodes: DataFrame, size: int | None) -> DataFrame:
    """(c, blk, n, step): a node for each block, or for each ``size`` nodes of the level below."""
    of_blocks = size is None
    if of_blocks:
        wanted = nodes.select("c", "blk", "n", F.col("codes").cast("array<long>").alias("items"))
    else:
        group = nodes.groupBy("c", F.expr(f"blk div {size}").alias("up"))
        rows = group.agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("blk", "step"))).alias("rows"))
        count = F.expr(f"(n + {size - 1}) div {size}").alias("n")
        wanted = rows.select("c", F.col("up").alias("blk"), count, F.flatten("rows.step").alias("items"))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [v if of_blocks else _steps(v) for v in batch.column(3).to_pylist()]
            steps = pa.array([_flat(H.product(x)) for x in items], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], steps], ["c", "blk", "n", "step"])

    return wanted.mapInArrow(products, "c string, blk long, n long, step array<long>")


def _cross(level: DataFrame, asked: DataFrame | None, size: int) -> DataFrame:
    """(c, blk, begin, finish) of every node of a level, from what is asked of the stretches above it."""
    group = level.groupBy("c", F.expr(f"blk div {size}").alias("up"))
    rows = group.agg(F.sort_array(F.collect_list(F.struct("blk", "step"))).alias("rows"))
    if asked is None:
        rows = rows.withColumns({"begin": F.lit(0), "finish": F.lit(None).cast("int")})
    else:
        rows = rows.join(asked.withColumnRenamed("blk", "up"), ["c", "up"])

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                state = row["begin"]
                ends = H.crossings(_steps(row["steps"]), state, row["finish"])
                for blk, end in zip(row["blks"], ends):
                    out.append((row["c"], blk, state, end))
                    state = end
            columns = list(zip(*out)) or [[], [], [], []]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), ["c", "blk", "begin", "finish"])

    wanted = rows.select("c", F.col("rows.blk").alias("blks"), F.flatten("rows.step").alias("steps"), "begin", "finish")
    return wanted.mapInArrow(cross, "c string, blk long, begin int, finish int")


def _solve_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct([("rid", pa.int64()), ("pos", pa.int64()), *((n, pa.string()) for n in ("before", "role", "after"))])
    )
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), kind]
    names = ["c", "blk", "cost", "audit", "illegal", "head", "tail", "edits"]
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            codes, state = row["codes"], row["begin"]
            cost, letters, edits = 0, [], []
            first = row["blk"] * row["size"]
            for i, (end, code) in enumerate(zip(H.crossings(codes, state, row["finish"]), codes)):
                price, audit, before, role = H.edits(code)[state][end]
                cost, state = cost + price, end
                letters.append(audit)
                edits.append({"rid": row["rids"][i], "pos": first + i, "before": before, "after": "",
                              "role": "=" if audit.endswith("K") else role})
            if row["last"]:
                edits[-1]["after"] = H.TRAILING[state]
                cost += H.END[state]
                letters.append("I" * len(H.TRAILING[state]))
            roles = "".join(H.ROLES[code // 3] for code in codes)
            illegal = sum(roles[i : i + 2] not in H.LEGAL for i in range(len(roles) - 1))
            out.append((row["c"], row["blk"], cost, "".join(letters), illegal, roles[0], roles[-1], edits))
        columns = list(zip(*out)) or [[] for _ in names]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), names)


def _report(stored: DataFrame, marked: DataFrame, solved: DataFrame) -> DataFrame:
    turns = marked.where("turn is not null").groupBy("c", "turn").agg(F.lit(1).alias("one"))
    high, low = [f("turn").cast("decimal(38,0)") for f in (F.max, F.min)]
    gaps = turns.groupBy("c").agg((high - low + 1 - F.count(F.lit(1))).cast("long").alias("gaps"))
    faults = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    counts = marked.groupBy("c").agg(*faults)
    follows = F.lead("head").over(Window.partitionBy("c").orderBy("blk"))
    seam = F.concat("tail", follows)
    broken = F.when(seam.isNotNull() & ~seam.isin(*sorted(H.LEGAL)), 1).otherwise(0)
    parts = solved.select("c", "blk", "cost", "audit", (F.col("illegal") + broken).alias("illegal"))
    edits = parts.groupBy("c").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.sort_array(F.collect_list(F.struct("blk", "audit")))["audit"], "").alias("audit"),
    )
    ids = stored.groupBy("c").agg(F.max("conv_id").alias("conv_id"))
    found = ids.join(counts, "c").join(edits, "c").join(gaps, "c", "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in
               ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("c", "conv_id", *numbers, "audit")


def _turns(stored: DataFrame, solved: DataFrame) -> DataFrame:
    edits = solved.select(F.inline("edits"))
    rows = stored.select("rid", "c", "conv_id", F.col("role").alias("said"), "text").join(edits, "rid")
    empty = F.lit("")
    name = [F.lit(x) for pair in NAMES.items() for x in pair]

    def added(initials: str) -> Column:
        letters = F.filter(F.split(initials, ""), lambda r: r != "")
        return F.transform(letters, lambda r: F.struct(F.create_map(*name)[r].alias("role"), empty.alias("text")))

    role = F.when(F.col("role") == "=", F.col("said")).otherwise(F.create_map(*name)[F.col("role")])
    own = F.array(F.struct(role.alias("role"), F.col("text").alias("text")))
    nothing = F.array().cast("array<struct<role:string,text:string>>")
    pieces = F.concat(added("before"), F.when(F.col("role") == "", nothing).otherwise(own), added("after"))
    lines = rows.select("c", "conv_id", "pos", F.posexplode(pieces).alias("part", "line"))
    return lines.select("c", "conv_id", "pos", "part", "line.role", "line.text")


def digests(turns: DataFrame) -> DataFrame:
    """(c, sha256) of the ``role:text`` lines of each conversation, read in order row by row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                line = f"{role}:{text}".encode()
                if c == now:
                    state.update(b"\n" + line)
                    continue
                if state is not None:
                    done.append((now, state.hexdigest()))
                now, state = c, hashlib.sha256(line)
            yield _pairs(done)
        if state is not None:
            yield _pairs([(now, state.hexdigest())])

    def _pairs(done: list[tuple[str, str]]) -> pa.RecordBatch:
        columns = [pa.array([x[i] for x in done], pa.string()) for i in range(2)]
        return pa.RecordBatch.from_arrays(columns, ["c", "sha256"])

    ordered = turns.repartition("c").sortWithinPartitions("c", "pos", "part").select("c", "role", "text")
    return ordered.mapInArrow(read, "c string, sha256 string")
