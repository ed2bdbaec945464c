"""Near duplicates by Jaccard similarity of word shingles, through a token-group matrix.

Texts of equal shingle sets are one class.  A shingle (token) of a class takes part if it is among
the rarest of the set, as many as any similar set must share ``SHARED`` of.  The rarest of those
are its front: as many as a similar set that is not smaller must share ``SHARED`` of.  Similar classes
are put into groups: first each with the class that leads most of its tokens, then by the links found.
The matrix holds each group's union of fronts; a class opens a group only if its tokens in the
union reach the bound, and only members, not larger than it, whose fronts reach it themselves are
compared exactly.  A group is split into blocks of a bounded number of tokens; the classes that open
a block meet its members as sorted arrays, and a component that is known already is not opened again.
Two sets that have a passage in common meet only where it fills eight ninths of the smaller one,
save for ``SHARED`` tokens, so passages that many texts hold bring few classes together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.anchors import keyed
from orderlens.llm.common import (
    byte_codes,
    in_slices,
    in_turn,
    lower,
    mix,
    pieces,
    release,
    slice_hashes,
    slice_number,
    utf8,
    word_bounds,
)
from orderlens.llm.graph import components
from orderlens.session import materialize

SHINGLE = 5
PERCENT = 80
# Tokens of the taking part that two similar classes share at least (all, where the sets are smaller).
SHARED = 3
# Counters by which tokens are ordered from rare to common.  Any counts give right results; these
# are hashed sums over all texts, 4 MB whatever the input.
COUNTERS = 1 << 20
SEGMENT = 1 << 16
# Tokens of the sets that are held in one row: members of a block, or classes that open it.
BLOCK_TOKENS = 1 << 17
# Turns in which texts are dealt out, so that a part of them lies on the disk at a time.
TURNS = 4
# Bytes of text that are hashed at a time, few enough for the arrays to stay in a core's cache.
PIECE = 1 << 19


def by_owner(order: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """``order`` sorted by owner, otherwise as it was."""
    owner = owner[order]
    small = len(owner) == 0 or owner.max() < 1 << 16  # numpy sorts 16-bit values by radix
    return order[np.argsort(owner.astype(np.uint16) if small else owner, kind="stable")]


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct shingles of each text, sorted."""
    data, offsets = utf8(column)
    starts, ends = word_bounds(data, offsets)
    words = slice_hashes(byte_codes(lower(data)), starts, ends)
    firsts = np.searchsorted(starts, offsets)
    counts = np.diff(firsts)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(np.arange(len(words)) + SHINGLE <= firsts[1:][text])
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    begin = np.concatenate([at, firsts[:-1][short]])
    end = np.concatenate([at + SHINGLE, firsts[1:][short]])
    owner = np.concatenate([text[at], short])
    hashes = slice_hashes(words, begin, end)
    order = by_owner(np.argsort(hashes), owner)
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], hashes[new]


def class_names(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, 64-bit name of the set) of each of ``n`` texts; the name of an empty set is 0."""
    sizes = np.bincount(owner, minlength=n)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    ends = np.cumsum(sizes)
    return sizes, mix(total[ends] - total[ends - sizes]).view(np.int64)


def token_counters(docs: DataFrame) -> np.ndarray:
    """How many shingles of all texts fall on each counter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.int64)
        for batch in pieces(batches, PIECE):
            counts += np.bincount((shingle_sets(batch.column(1))[1] % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        parts = counts.reshape(-1, SEGMENT)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([p.tobytes() for p in parts])], ["segment", "counts"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[segment] = sums.get(segment, 0) + np.frombuffer(counts, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["segment", "counts"]
        )

    schema = "segment int, counts binary"
    found = docs.select("d", "text").mapInArrow(count, schema)
    # each reducer adds up what it gets, so none holds more than the counters
    summed = found.repartition(COUNTERS // SEGMENT, "segment").mapInArrow(add, schema)
    out = np.zeros(COUNTERS, dtype=np.int64)
    for row in summed.collect():  # one row per segment: 8 MB whatever the input
        part = np.frombuffer(row["counts"], dtype=np.int64)
        out[row["segment"] * SEGMENT : (row["segment"] + 1) * SEGMENT] += part
    return out


def sizes_fit(a: Column, b: Column) -> Column:
    return (100 * F.least(a, b)) >= PERCENT * F.greatest(a, b)


def needed(n: Column) -> Column:
    """Shared tokens below which a class of n shingles has no similar class in a group."""
    return F.least(F.lit(SHARED), F.ceil(n * PERCENT / 100))


def several_classes(rows: DataFrame, of: str = "class") -> DataFrame:
    """The tokens that two classes (or groups) have, one of them in a front."""
    found = rows.groupBy("token").agg(F.min(of).alias("low"), F.max(of).alias("high"), F.max("front").alias("front"))
    return found.where("low <> high and front").select("token")


def class_tokens(docs: DataFrame) -> DataFrame:
    """Stored (token, class, n, front): tokens taking part that more than one class has."""
    counters = docs.sparkSession.sparkContext.broadcast(np.minimum(token_counters(docs), np.iinfo(np.int32).max).astype(np.int32))

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, PIECE):
            owner, hashes = shingle_sets(batch.column(1))
            sizes, names = class_names(owner, hashes, batch.num_rows)
            counts = counters.value[(hashes % np.uint64(COUNTERS)).astype(np.int64)]
            # by count, then hash: the hashes of an owner are in order already
            order = np.sort(counts.astype(np.int64) << 32 | np.arange(len(counts))) & 0xFFFFFFFF
            order = by_owner(order, owner)
            rank = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = rank < (sizes - (PERCENT * sizes + 99) // 100 + SHARED)[owner]  # owner is sorted either way
            at, own = order[keep], owner[keep]
            front = rank[keep] < (sizes - (2 * PERCENT * sizes + 99 + PERCENT) // (100 + PERCENT) + SHARED)[own]
            cells = [hashes[at].view(np.int64), names[own], sizes[own].astype(np.int32), front]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["token", "class", "n", "front"])

    rows = docs.select("d", "text").mapInArrow(rarest, "token long, class long, n int, front boolean")
    stored = []

    def shared(part: DataFrame) -> DataFrame:
        stored.append(materialize(several_classes(part), "tokens"))
        return part.join(stored[-1], "token").distinct()

    found = in_slices(rows, "token", "class-tokens", shared)
    release(*stored)
    # a class with too few such tokens has no similar class, and leaves others with fewer
    for _ in range(2):
        before = found
        enough = found.groupBy("class", "n").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= needed(F.col("n")))
        found = found.join(materialize(enough.select("class"), "classes"), "class", "left_semi")
        found = found.join(materialize(several_classes(found), "tokens"), "token", "left_semi")
        found = materialize(found.select("token", "class", "n", "front"), "class-tokens")
        release(before)
    return found


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar, compared exactly."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    first = sets.select(F.col("class").alias("a"), F.col("tokens").alias("x"))
    second = sets.select(F.col("class").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y")
    return both.mapInArrow(compare, "a long, b long")


def parts_of(rows: DataFrame, key: str) -> DataFrame:
    """The rows with a part of their key, each part holding about ``BLOCK_TOKENS`` tokens."""
    parts = rows.groupBy(key).agg(F.ceil(F.sum("n") / BLOCK_TOKENS).alias("parts"))
    return rows.join(parts, key).withColumn("part", F.pmod(F.xxhash64("class"), "parts")).drop("parts")


def top(root: dict[int, int], node: int) -> int:
    """What a node hangs on in the end; the way there is halved."""
    while node in root:
        above = root[node]
        if above in root:
            root[node] = root[above]
        node = above
    return node


def block_links(opened: DataFrame, blocks: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of the classes that open a block with its members, without those that join no more components.

    ``opened`` is (class, n, own, block), ``blocks`` is (class, own, block); own names the component.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.zeros((2, 0), dtype=np.int64)]
            for asked, members in zip(batch.column(0), batch.column(1)):
                asked, members = asked.values, members.values
                names, owns = (members.field(i).to_numpy() for i in (0, 1))
                data, offsets = utf8(members.field(2))
                sizes = np.diff(offsets) // 8
                tokens = np.frombuffer(data.tobytes(), dtype=np.uint64)
                root: dict[int, int] = {}  # components joined in this row
                order = np.argsort(tokens, kind="stable")
                tokens, owner = tokens[order], np.repeat(np.arange(len(sizes)), sizes)[order]
                for name, own, held in zip(*(asked.field(i).to_pylist() for i in range(3))):
                    x = np.frombuffer(held, dtype=np.uint64)
                    low, high = np.searchsorted(tokens, x, "left"), np.searchsorted(tokens, x, "right")
                    n = high - low
                    at = np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)
                    both = np.bincount(owner[at], minlength=len(sizes))
                    similar = np.flatnonzero((100 * both >= PERCENT * (len(x) + sizes - both)) & (owns != own))
                    new = []
                    for i in similar[np.unique(owns[similar], return_index=True)[1]]:
                        a, b = top(root, own), top(root, int(owns[i]))
                        if a != b:
                            root[a] = b
                            new.append(names[i])
                    out.append(np.array([[name] * len(new), new], dtype=np.int64))
            a, b = np.concatenate(out, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def packed(rows: DataFrame, name: str, *key: str) -> DataFrame:
        held = rows.join(sets.select("class", "tokens"), "class")
        return held.groupBy(*key).agg(F.collect_list(F.struct("class", "own", "tokens")).alias(name))

    asked = packed(parts_of(opened, "block"), "asked", "block", "part")
    members = packed(blocks.join(opened.select("block").distinct(), "block", "left_semi"), "members", "block")
    return asked.join(members, "block").select("asked", "members").mapInArrow(meet, "a long, b long")


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def class_links(tokens: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, label) of the classes that are similar to another; drops both stored tables."""
    # each class with the class that is the least of most of its tokens
    least = materialize(tokens.groupBy("token").agg(F.min("class").alias("least")), "least")
    shares = tokens.join(least, "token").where("class <> least").groupBy("class", "n", "least")
    shares = shares.agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= needed(F.col("n")))
    leaders = shares.groupBy("class").agg(F.max_by("least", F.struct("shared", "least")).alias("leader"))
    tested = materialize(leaders.select(*ordered(F.col("class"), F.col("leader"))).distinct(), "pairs")
    found = materialize(links(tested, sets), "links")
    labels = materialize(components(found), "labels")

    def grouped() -> DataFrame:
        """Tokens with the group of their class, where several groups have the token."""
        rows = tokens.join(labels.withColumnRenamed("node", "class"), "class", "left")
        rows = rows.select("token", "class", "n", "front", F.coalesce("label", "class").alias("group"), "label")
        spread = materialize(several_classes(rows, "group"), "open-tokens")
        return materialize(rows.join(spread, "token"), "grouped")

    # each class with classes of other groups that stand for enough of its tokens: brings copies
    # together that the first choice of leaders has kept apart
    rows = grouped()
    centre = F.min(F.struct(F.xxhash64("class", F.lit(1)).alias("order"), "class", "group", "n")).alias("c")
    centres = materialize(rows.groupBy("token").agg(centre), "centres")
    star = rows.join(centres, "token").where((F.col("group") != F.col("c.group")) & sizes_fit(F.col("n"), F.col("c.n")))
    star = star.groupBy("class", "n", F.col("c.class").alias("centre")).agg(F.count(F.lit(1)).alias("shared"))
    star = star.where(F.col("shared") >= needed(F.col("n"))).select(*ordered(F.col("class"), F.col("centre"))).distinct()
    star = star.join(tested, ["a", "b"], "left_anti")
    star = materialize(star, "pairs")
    release(rows)
    found = materialize(found.union(links(star, sets)), "links")
    labels = materialize(components(found), "labels")

    # groups: components found so far, and the other classes by the class that leads most of their tokens
    stored_rows = rows = grouped()
    leads = rows.where("label is null").join(least, "token").groupBy("class", "least").agg(F.count(F.lit(1)).alias("shared"))
    leads = leads.groupBy("class").agg(F.max_by("least", F.struct("shared", "least")).alias("lead"))
    kinds = rows.select("class", "n", F.col("group").alias("own"), "label").distinct()
    kinds = kinds.join(leads, "class", "left").withColumn("group", F.coalesce("label", "lead"))
    blocks = parts_of(kinds, "group").select("class", "own", F.xxhash64("group", "part", F.col("label").isNull()).alias("block"))
    blocks = materialize(blocks, "blocks")

    # the matrix: which blocks has a class enough tokens in, and of which members that are not larger
    rows = rows.select("token", "class", "n", "front").join(blocks, "class")
    matrix = rows.where("front").groupBy("token", F.col("block").alias("to")).agg(
        F.min("n").alias("low_n"), F.max("n").alias("high_n"), F.min("own").alias("low"), F.max("own").alias("high")
    )
    matrix = materialize(matrix, "matrix")
    other = (F.col("low") != F.col("own")) | (F.col("high") != F.col("own"))
    fits = (F.col("low_n") <= F.col("n")) & (100 * F.col("high_n") >= PERCENT * F.col("n"))
    over = rows.select("token", "class", "n", "own").join(matrix, "token").where(other & fits)
    over = over.groupBy("class", "n", "own", F.col("to").alias("block")).agg(F.count(F.lit(1)).alias("shared"))
    opened = over.where(F.col("shared") >= needed(F.col("n"))).select("class", "n", "own", "block")
    opened = materialize(opened, "opened")
    release(tokens, stored_rows, matrix)
    rest = materialize(block_links(opened, blocks, sets), "links")
    release(sets)
    return materialize(components(found.union(rest)), "labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, d, key, n_shingles, component_id) of every row of ``docs``.

    Words are lower-cased in A-Z and end at ASCII white space; a text of one to four words is
    one shingle.  Texts link when the Jaccard similarity of their sets is at least 0.8; the
    component is the least id that links lead to.  Null, empty or blank texts have no shingle and
    are their own component.  Rows that repeat are linked; among them, null ids never name a
    component unless all are null.  An empty table gives no rows; other columns are ignored.
    ``d`` and ``key`` name the row's id and text.  Sets are told apart by 64-bit hashes.
    """
    rows = keyed(docs)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, PIECE):
            sizes, names = class_names(*shingle_sets(batch.column(1)), batch.num_rows)
            cells = [batch.column(0), batch.column(2), batch.column(3), pa.array(sizes.astype(np.int64)), pa.array(names)]
            yield pa.RecordBatch.from_arrays(cells, ["d", "key", "doc_id", "n_shingles", "class"])

    schema = "d long, key long, doc_id long, n_shingles long, class long"
    described = rows.select("d", "text", "key", "doc_id").mapInArrow(describe, schema)
    described = materialize(described, "described")
    tokens = class_tokens(rows)

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, PIECE):
            owner, hashes = shingle_sets(batch.column(1))
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            cells = [hashes[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.binary())], ["class", "tokens"])

    # one text of each class that shares a token
    asked = tokens.select("class").distinct()
    one = described.join(asked, "class").groupBy("class").agg(F.min(F.struct("d", "key")).alias("row"))
    one = one.select("class", "row.d", "row.key")
    one = materialize(one, "representatives")

    def sets_in(turn: int) -> DataFrame:
        held = rows.select("d", "key", "text").where(slice_number("key", TURNS) == turn).join(one, ["d", "key"])
        return held.select("class", "text").dropDuplicates(["class"]).mapInArrow(sets_of, "class long, tokens binary")

    sets = in_turn(map(sets_in, range(TURNS)), "sets")

    labels = class_links(tokens, sets).withColumnRenamed("node", "class")
    full = described.where("n_shingles > 0").join(labels, "class", "left")
    full = full.select("d", "key", "doc_id", "n_shingles", F.coalesce("label", "class").alias("group"))
    least = materialize(full.groupBy("group").agg(F.min("doc_id").alias("component_id")), "components")
    empty = described.where("n_shingles = 0").select("doc_id", "d", "key", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.join(least, "group").select("doc_id", "d", "key", "n_shingles", "component_id").union(empty)
