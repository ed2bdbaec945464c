"""Benchmark items inside documents, by SimHash windows; DataFrame functions only.

Words are runs of letters and digits in lower case, shingles five words.  Where a document shares
a shingle with an item, the window of the item's length in which that shingle lies at its place
in the item is fingerprinted.  Fingerprints are cut into blocks; an item is entered under all
values of a block that differ in few bits, so every window within the radius meets it under one
block at least.  The exact similarity of shingle weights, here their numbers, then decides.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import texts
from orderlens.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = 8  # of eight bits each
FLIPS = 2  # bits that may differ in a block
# Pigeonhole: with at most 23 differing bits, one of 8 blocks has at most 2 of them.  Texts of
# similarity 0.8 differ in 10 of 64 bits on average, and in more than 23 twice in a million.
RADIUS = BLOCKS * (FLIPS + 1) - 1
# Shingles of all items up to which they are sent to every task (16 bytes each); beyond, they are joined by a shuffle.
MOST_SENT = 1_000_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(0))


def shingles(text: Column) -> Column:
    """Array of shingle hashes in order; a text of one to four words is one shingle, of none has none."""

    def of(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[w[i + j] for j in range(SHINGLE)])
        )
        return F.when(F.size(w) >= SHINGLE, hashes).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array())

    return F.transform(F.array(words(text)), of)[0]


def fingerprints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fingerprint, n): a 64-bit SimHash over the rows' shingles ``h``; each row is one vote."""
    # two 32-bit counters to a sum
    sums = [
        F.sum(F.shiftright("h", i).bitwiseAND(1) + F.shiftleft(F.shiftright("h", i + 32).bitwiseAND(1), 32)).alias(f"s{i}")
        for i in range(32)
    ]
    summed = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums)

    def bit(i: int) -> Column:
        ones = F.shiftright(f"s{i % 32}", 32 * (i // 32)).bitwiseAND(0xFFFFFFFF)
        return F.shiftleft(F.when(2 * ones > F.col("n"), F.lit(1)).otherwise(F.lit(0)).cast("long"), i)

    halves = []
    for low in (0, 32):
        value = bit(low)
        for i in range(low + 1, low + 32):
            value = value.bitwiseOR(bit(i))
        halves.append(value)
    return summed.select(*keys, "n", halves[0].bitwiseOR(halves[1]).alias("fingerprint"))


def blocks(rows: DataFrame, flips: int) -> DataFrame:
    """The rows once for each block and each value that differs from the fingerprint's in up to ``flips`` bits."""
    masks = [sum(1 << b for b in c) for n in range(flips + 1) for c in combinations(range(8), n)]
    own = [F.shiftrightunsigned("fingerprint", 8 * i).bitwiseAND(255).cast("int") for i in range(BLOCKS)]
    parts = F.array(*[F.struct(F.lit(i).alias("block"), v.alias("own")) for i, v in enumerate(own)])
    out = rows.select("*", F.inline(parts))
    if flips:
        out = out.select("*", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
        return out.withColumn("value", F.col("own").bitwiseXOR(F.col("mask"))).drop("own", "mask")
    return out.withColumnRenamed("own", "value")


def pair_names() -> tuple[Column, Column]:
    """Two 64-bit names of the pair of id and text, null ids included."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return F.xxhash64(doc_id, text), F.xxhash64(text, F.lit(1), doc_id)


def matches(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, k1, k2, item_id, start, n_shingles, similarity, distance) of every window that matches an item.

    ``items`` has (item_id, text).  ``start`` is the window's first word.  Documents shorter than
    an item are one window.  Null or empty texts, of documents or items, match nothing; an item
    without id gives matches without id; repeated items match each; rows that repeat both id and
    text count once.  Empty tables give no rows; other columns are ignored.
    """
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    wanted = wanted.select("item_id", F.xxhash64("item_id", "text").alias("item"), shingles(F.col("text")).alias("hashes"))
    item_rows = wanted.dropDuplicates(["item"]).select(
        "item", "item_id", F.size("hashes").alias("m"), F.posexplode("hashes").alias("place", "h")
    )
    seeds = item_rows.select("h", "place", "m").distinct()
    if seeds.count() <= MOST_SENT:
        seeds = F.broadcast(seeds)

    k1, k2 = pair_names()
    keyed = texts(docs).where(F.col("text").isNotNull()).withColumns({"k1": k1, "k2": k2})
    hits = keyed.select("k1", "k2", F.posexplode(shingles(F.col("text"))).alias("pos", "h")).join(seeds, "h")
    starts = hits.select("k1", "k2", F.struct(F.greatest(F.col("pos") - F.col("place"), F.lit(0)).alias("start"), "m").alias("w"))
    per_doc = starts.groupBy("k1", "k2").agg(F.collect_set("w").alias("windows"))

    # windows as rows of shingles; one that would pass the end of the text ends with it
    opened = keyed.join(per_doc, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    opened = opened.select("doc_id", "k1", "k2", "windows", shingles(F.col("text")).alias("hashes"))
    start = F.greatest(F.lit(0), F.least(F.col("start"), F.size("hashes") - F.col("m")))
    window = ["doc_id", "k1", "k2", "start", "m"]
    opened = opened.select("doc_id", "k1", "k2", "hashes", F.inline("windows"))
    opened = opened.select("doc_id", "k1", "k2", start.alias("start"), "m", "hashes").dropDuplicates(window)
    rows = materialize(opened.select(*window, F.explode(F.expr("slice(hashes, start + 1, m)")).alias("h")), "windows")

    of_items = blocks(fingerprints(item_rows, ["item", "item_id", "m"]), FLIPS)
    of_items = of_items.select("item", "item_id", "m", "block", "value", F.col("n").alias("item_n"), F.col("fingerprint").alias("item_print"))
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print")))
    pairs = (
        blocks(fingerprints(rows, window), 0)
        .join(of_items, ["m", "block", "value"])
        .withColumn("distance", distance)
        .where(F.col("distance") <= radius)
        .select(*window, "n", "item", "item_id", "item_n", "distance")
        .distinct()
    )

    counted = rows.groupBy("k1", "k2", "start", "m", "h").agg(F.count(F.lit(1)).alias("c"))
    wanted = item_rows.groupBy("item", "h").agg(F.count(F.lit(1)).alias("item_c"))
    shared = (
        pairs.join(counted, ["k1", "k2", "start", "m"])
        .join(wanted, ["item", "h"])
        .groupBy(*pairs.columns)
        .agg(F.sum(F.least("c", "item_c")).alias("both"))
    )
    either = F.col("n") + F.col("item_n") - F.col("both")
    return shared.where(F.col("both") * 10**6 >= either * round(similarity * 10**6)).select(
        "doc_id", "k1", "k2", "item_id", "start", F.col("n").alias("n_shingles"), (F.col("both") / either).alias("similarity"), "distance"
    )


def contaminated(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """(doc_id, item_id, similarity, start): for each document and item it holds, the most similar window."""
    best = F.max_by(F.struct("similarity", "start"), F.struct("similarity", -F.col("start"))).alias("best")
    found = matches(docs, items, **settings).groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", "best.similarity", "best.start")


def without_items(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item."""
    keys = matches(docs, items, **settings).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
    k1, k2 = pair_names()
    named = docs.select(F.struct("*").alias("row"), k1.alias("_k1"), k2.alias("_k2"))
    return named.join(keys, ["_k1", "_k2"], "left_anti").select("row.*")
