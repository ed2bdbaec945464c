"""Cross-entropy difference of documents under two matched n-gram models.

Tokens are characters and both models share one vocabulary: all characters of the corpus.  The
background model counts all documents, the target model the chosen ones, with the same orders and
the same smoothing.  Counts are taken per block of documents, so a gram is shuffled once for each
block that has it, not once for each place; its losses travel back to those blocks the same way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import many_slice_hashes, mix, pieces, slice_hashes, texts
from orderlens.session import materialize

ORDER = 4
BLOCK = 4096  # documents of a block, about
SMOOTHING = 4.0  # weight of the lower order's probability, in tokens
PARTS = ["gram", "context", "pair", "before", "last"]


def characters(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, place after each character, number of characters of each text); a text begins with ORDER - 1 marks."""
    strings = [t or "" for t in column.to_pylist()]
    n = np.array([len(t) for t in strings], dtype=np.int64)
    mark = "\0" * (ORDER - 1)
    codes = np.frombuffer("".join(mark + t for t in strings).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = mix(codes.astype(np.uint64) + np.uint64(1))
    ends = np.arange(len(codes)) + 1
    return codes, ends[np.arange(len(codes)) >= np.repeat(np.cumsum(n + ORDER - 1) - n, n + ORDER - 1)], n


def part_hashes(codes: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Hashes of the PARTS of the grams that end at ``ends``: the whole gram, its context, the last two
    characters, the one before the last, and the last."""
    spans = [(ORDER, 0), (ORDER, 1), (2, 0), (2, 1), (1, 0)]
    return [h.view(np.int64) for h in many_slice_hashes(codes, [(ends - a, ends - b) for a, b in spans])]


def kinds_of(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different grams, which of them ends at each of ``ends``), by hashing: a block has few grams for its length."""
    found = pa.array(slice_hashes(codes, ends - ORDER, ends).view(np.int64)).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy()


def blocked(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(block, text, doc_id, target) with about ``block`` rows a block, by a hash of id and text."""
    rows = texts(docs)
    n = max(1, -(-rows.count() // block))
    return rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("block"), "text", "doc_id")


def block_grams(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Stored (block, parts of the gram, background, target): places of each gram in a block."""

    def count(docs: pa.Table, chosen: pa.Table) -> pa.Table:
        ids = chosen.column("target_id").to_numpy()
        found: list[np.ndarray] = [np.zeros((0, 7), dtype=np.int64)]
        for batch in docs.select(["block", "text", "doc_id"]).to_batches():
            for piece in pieces(iter([batch])):
                codes, ends, n = characters(piece.column(1))
                mine = np.isin(np.array([-1 if d is None else d for d in piece.column(2).to_pylist()], dtype=np.int64), ids)
                mine &= piece.column(2).is_valid().to_numpy(zero_copy_only=False)
                different, kind = kinds_of(codes, ends)
                place = np.empty(len(different), dtype=np.int64)
                place[kind] = ends  # equal grams have equal parts, wherever they lie
                counts = np.bincount(kind, minlength=len(different))
                of_target = np.bincount(kind, weights=np.repeat(mine, n), minlength=len(different)).astype(np.int64)
                found.append(np.column_stack([*part_hashes(codes, place), counts, of_target]))
        grams = np.concatenate(found)
        order = np.argsort(grams[:, 0], kind="stable")
        grams = grams[order]
        new = np.flatnonzero(np.concatenate([[True], grams[1:, 0] != grams[:-1, 0]])) if len(grams) else np.zeros(0, int)
        sums = np.add.reduceat(grams[:, 5:], new, axis=0) if len(grams) else grams[:, 5:]
        block = docs.column("block")[0].as_py() if docs.num_rows else 0
        cells = [pa.array(np.full(len(new), block, dtype=np.int32))]
        cells += [pa.array(np.ascontiguousarray(grams[new, i])) for i in range(5)]
        cells += [pa.array(np.ascontiguousarray(sums[:, i])) for i in range(2)]
        return pa.Table.from_arrays(cells, ["block", *PARTS, "background", "target"])

    schema = "block int, " + ", ".join(f"`{p}` long" for p in PARTS) + ", background long, target long"
    grouped = rows.groupBy("block").cogroup(targets.groupBy("target_block"))
    return materialize(grouped.applyInArrow(count, schema), "block-grams")


def gram_losses(found: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """Stored (gram, target_loss, background_loss) of every gram, in nats."""
    sums = [F.sum(c).alias(c) for c in ("background", "target")]
    grams = materialize(found.groupBy(*PARTS).agg(*sums), "grams")

    def of(part: str) -> DataFrame:
        return grams.groupBy(part).agg(*[F.sum(c).alias(f"{part}_{c}") for c in ("background", "target")])

    last = of("last")
    whole = last.agg(
        F.count(F.lit(1)).alias("vocabulary"), *[F.sum(f"last_{c}").alias(f"all_{c}") for c in ("background", "target")]
    )
    totals = whole.first()
    rows = grams
    for part in ("context", "pair", "before"):
        rows = rows.join(of(part), part)
    rows = rows.join(last, "last")

    def loss(model: str) -> Column:
        p = (F.col(f"last_{model}") + 1) / F.lit(float((totals[f"all_{model}"] or 0) + totals["vocabulary"]))
        p = (F.col(f"pair_{model}") + smoothing * p) / (F.col(f"before_{model}") + smoothing)
        p = (F.col(model) + smoothing * p) / (F.col(f"context_{model}") + smoothing)
        return -F.log(p)

    losses = rows.select("gram", loss("target").alias("target_loss"), loss("background").alias("background_loss"))
    return materialize(losses, "losses")


def entropy_difference(docs: DataFrame, targets: DataFrame, block: int = BLOCK, smoothing: float = SMOOTHING) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of every row of ``docs``.

    ``targets`` names the target documents by doc_id; null and unknown ids name none, repeated
    ones count once.  Losses are means per character over the whole text, ``score`` is
    background_loss - target_loss: the greater, the closer to the target.  Null and empty texts
    have no tokens, losses of 0 and a score of 0.  Without any target the target model is even
    over the vocabulary.  Repeated rows are each scored; an empty table gives no rows; other
    columns are ignored.
    """
    rows = blocked(docs, block)
    chosen = targets.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull()).distinct()
    chosen = rows.select("block", "doc_id").join(chosen, "doc_id").select(
        F.col("block").alias("target_block"), F.col("doc_id").alias("target_id")
    )
    found = block_grams(rows, chosen)
    losses = gram_losses(found, smoothing)
    sent = found.select("block", "gram").join(losses, "gram")

    def score(docs: pa.Table, model: pa.Table) -> pa.Table:
        grams, target, background = (model.column(c).to_numpy() for c in ("gram", "target_loss", "background_loss"))
        order = np.argsort(grams)
        grams, both = grams[order], (target[order], background[order])
        out = []
        for batch in docs.select(["doc_id", "text"]).to_batches():
            for piece in pieces(iter([batch])):
                codes, ends, n = characters(piece.column(1))
                different, kind = kinds_of(codes, ends)
                place = np.searchsorted(grams, different)[kind]
                ends, means = np.cumsum(n), []
                for losses in both:
                    total = np.zeros(len(place) + 1)
                    np.cumsum(losses[place], out=total[1:])
                    means.append((total[ends] - total[ends - n]) / np.maximum(n, 1))
                cells = [piece.column(0), pa.array(n), *map(pa.array, means), pa.array(means[1] - means[0])]
                out.append(pa.RecordBatch.from_arrays(cells, names))
        return pa.Table.from_batches(out, pa.schema(list(zip(names, kinds))))

    names = ["doc_id", "n_tokens", "target_loss", "background_loss", "score"]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    schema = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"
    return rows.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(score, schema)
