"""Winnowed anchors of long repeats in sequences of symbols (words or bytes)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import gram_hashes, mix, pieces, slice_hashes, utf8


@dataclass
class Anchors:
    """Anchors of the windows of a batch of texts; every window has exactly one.

    The anchor of a window is the leftmost of its grams with the least upper half of the hash, so equal
    windows have equal anchors at equal places.
    """

    text: np.ndarray  # number of the text in the batch
    gram: np.ndarray  # hash of the anchor
    place: np.ndarray  # where the anchor lies in the text
    first: np.ndarray  # first window of the text that has this anchor
    count: np.ndarray  # windows in a row that have it
    spans: list[np.ndarray]  # hashes of all that these windows cover


def least_at(values: np.ndarray, width: int) -> np.ndarray:
    """Where the leftmost of values[i:i+width] with the least upper half lies, for every full window i."""
    half = np.uint64(32)  # a value's upper half and its place make one number; no batch has 2^32 symbols
    low, span = ((values >> half) << half) | np.arange(len(values), dtype=np.uint64), 1
    while span < width:
        step = min(span, width - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    return (low & np.uint64((1 << 32) - 1)).astype(np.int64)


def find(codes: np.ndarray, offsets: np.ndarray, length: int, gram: int, spans: int = 2) -> Anchors:
    """Anchors of all windows of ``length`` symbols in each text codes[offsets[i]:offsets[i+1]]."""
    n = len(codes)
    if n < length:
        none = np.zeros(0, dtype=np.int64)
        return Anchors(none, none.astype(np.uint64), none, none, none, [none.astype(np.uint64)] * spans)
    grams = gram_hashes(codes, gram)
    chosen = least_at(grams, length - gram + 1)
    inside = np.ones(len(chosen), dtype=bool)  # windows that lie in one text
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        inside[max(a, b - length + 1) : b] = False
    new = inside.copy()
    new[1:] &= (chosen[1:] != chosen[:-1]) | ~inside[:-1]
    new[offsets[:-1][offsets[:-1] < len(new)]] = True
    new &= inside
    edges = np.flatnonzero(new | ~inside)
    ends = np.append(edges[1:], len(chosen))[new[edges]]
    first = edges[new[edges]]
    place, text = chosen[first], np.searchsorted(offsets, first, side="right") - 1
    last = ends - 1 + length
    shift = mix((place - first).astype(np.uint64))
    hashes = [slice_hashes(codes, first, last, seed) ^ shift for seed in range(1, spans + 1)]
    base = offsets[:-1][text]
    return Anchors(text, grams[place], place - base, first - base, ends - first, hashes)


def pair_of(docs: DataFrame) -> tuple[Column, Column]:
    """Two values, never null, that together name a row's id and text; a null text is as an empty one."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.coalesce(doc_id, F.lit(-1)), F.xxhash64(doc_id, text)


def keyed(docs: DataFrame) -> DataFrame:
    """(d, key, doc_id, text) of every row; d and key name its id and text, null texts are empty."""
    d, key = pair_of(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(d.alias("d"), key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def table(docs: DataFrame, read, length: int, gram: int, spans: int = 2) -> DataFrame:
    """(anchor, span1, span2, d, key, place, first, n) of all texts; ``read`` gives (codes, offsets) of (bytes, offsets).

    ``spans`` is the number of hashes span1, span2 of what the windows cover.
    """
    hashes = [f"span{i}" for i in range(1, spans + 1)]
    names = ["anchor", *hashes, "d", "key", "place", "first", "n"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            d, key = (batch.column(i).to_numpy() for i in (0, 2))
            found = find(*read(*utf8(batch.column(1))), length, gram, spans)
            ids = [d[found.text], key[found.text]]
            longs = [x.astype(np.int64) for x in (found.gram, *found.spans)] + ids
            ints = [x.astype(np.int32) for x in (found.place, found.first, found.count)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in longs + ints], names)

    schema = "".join(f"{c} long, " for c in ["anchor", *hashes, "d", "key"]) + "place int, first int, n int"
    return docs.select("d", "text", "key").mapInArrow(rows, schema)
