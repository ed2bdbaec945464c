"""Substring dedup over words by seed and extend.

Every window of ``length`` words has one winnowed anchor; equal windows have equal anchors.
Documents are joined on anchors that occur again.  Where everything that the windows of an anchor
cover is the same at all its places, the match is extended over it at once; elsewhere the match is
extended word by word, by the windows themselves.  Matched windows that touch are one maximal repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm import anchors
from orderlens.llm.common import byte_codes, pieces, slice_hashes, utf8, word_bounds
from orderlens.session import materialize

GRAM = 10  # words of an anchor


def word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of the first word of each text and an end mark)."""
    starts, ends = word_bounds(data, offsets)
    return slice_hashes(byte_codes(data), starts, ends), np.searchsorted(starts, offsets)


def repeated_anchors(found: DataFrame) -> DataFrame:
    """(anchor, same): stored anchors that occur more than once; same if all their spans are equal."""
    counted = found.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("places"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("span1", "span2") for f in (F.min, F.max)],
    )
    same = (F.col("min_span1") == F.col("max_span1")) & (F.col("min_span2") == F.col("max_span2"))
    return materialize(counted.where("places > 1").select("anchor", same.alias("same")), "anchors")


def candidates(docs: DataFrame, read, length: int, gram: int) -> DataFrame:
    """Stored (d, key, text, spans) of the texts that hold a repeated anchor; spans are (first, n, same)."""
    found = anchors.table(docs, read, length, gram)
    again = repeated_anchors(found)
    held = found.join(again, "anchor").select("d", "key", F.struct("first", "n", "same").alias("span"))
    per_text = held.groupBy("d", "key").agg(F.collect_list("span").alias("spans"))  # as long as the text at most
    return materialize(docs.select("d", "key", "text").join(per_text, ["d", "key"]), "candidates")


def matched_windows(held: DataFrame, read, length: int) -> DataFrame:
    """(d, key, windows): first symbols of the open windows that occur again."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            codes, offsets = read(*utf8(batch.column(1)))
            d, key, spans = batch.column(0).to_numpy(), batch.column(2).to_numpy(), batch.column(3)
            text = np.repeat(np.arange(len(d)), np.diff(spans.offsets.to_numpy()))
            first, n, same = (x.to_numpy(zero_copy_only=False) for x in spans.flatten().flatten())
            use = ~same
            text, first, n = text[use], first[use].astype(np.int64), n[use].astype(np.int64)
            total = np.cumsum(n)
            within = np.arange(total[-1] if len(total) else 0) - np.repeat(total - n, n)
            text, at = np.repeat(text, n), np.repeat(first, n) + within
            start = offsets[:-1][text] + at
            cells = [slice_hashes(codes, start, start + length, seed).view(np.int64) for seed in (1, 2)]
            cells += [d[text], key[text], at.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["w1", "w2", "d", "key", "at"])

    windows = held.select("d", "text", "key", "spans").where(F.exists("spans", lambda s: ~s["same"]))
    windows = materialize(windows.mapInArrow(hashes, "w1 long, w2 long, d long, key long, at int"), "windows")
    again = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("places")).where("places > 1")
    again = materialize(again.select("w1", "w2"), "repeated-windows")
    return windows.join(again, ["w1", "w2"]).groupBy("d", "key").agg(F.collect_list("at").alias("windows"))


def covered(size: int, first: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Which of ``size`` symbols lie in one of the windows first .. first+count-1."""
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, np.minimum(first + count - 1 + length, size), -1)
    return np.cumsum(change[:size]) > 0


def runs(mask: np.ndarray) -> np.ndarray:
    """(start, end) of each maximal run of true."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges.reshape(-1, 2)


def remove_repeats(docs: DataFrame, length: int = 35, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256, repeats) of every row of ``docs``.

    Words end at space, tab, line feed, vertical tab, form feed and carriage return.  Every
    word in a window of ``length`` words that starts in another place too, of the same text or
    another, is removed; ``kept`` holds the others joined by one space where some are removed
    (else null) and ``repeats`` the (start, end) of the maximal removed runs.

    Null or empty texts have no words.  Repeated rows repeat each other, also with equal or
    null ids.  An empty table gives no rows; other columns are ignored.  Equality of windows is
    that of two 64-bit hashes of their words.
    """
    rows = anchors.keyed(docs)
    held = candidates(rows, word_codes, length, gram)
    hits = matched_windows(held, word_codes, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                words = r["text"].encode().split()
                first = [s["first"] for s in r["spans"] if s["same"]] + (r["windows"] or [])
                count = [s["n"] for s in r["spans"] if s["same"]] + [1] * len(r["windows"] or [])
                mask = covered(len(words), np.array(first, np.int64), np.array(count, np.int64), length)
                kept = b" ".join([w for w, m in zip(words, mask.tolist()) if not m])
                digest = hashlib.sha256(kept).hexdigest()
                spans = [{"start": a, "end": b} for a, b in runs(mask).tolist()]
                out.append((r["d"], r["key"], int(mask.sum()), kept.decode(), digest, spans))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            kinds.append(pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            columns = list(zip(*out)) or [()] * 6
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["d", "key", "n_removed", "kept", "digest", "repeats"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [t.encode().split() for t in batch.column(3).to_pylist()]
            cells = list(batch.columns[:3]) + [
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(cells, ["d", "key", "doc_id", "n_words", "sha"])

    fields = "d long, key long, n_removed long, kept string, digest string, repeats array<struct<start:int,end:int>>"
    changed = held.join(hits, ["d", "key"], "left").mapInArrow(cut, fields).where("n_removed > 0")
    changed = changed.dropDuplicates(["d", "key"])
    every = rows.mapInArrow(whole, "d long, key long, doc_id long, n_words long, sha string")
    return every.join(changed, ["d", "key"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        "kept",
        F.coalesce("digest", "sha").alias("kept_sha256"),
        F.coalesce("repeats", F.array().cast("array<struct<start:int,end:int>>")).alias("repeats"),
    )
