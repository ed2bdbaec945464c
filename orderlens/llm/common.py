"""Shared helpers: session settings, document columns, and array code over Arrow strings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import configure, delete_path, scratch_path

# Bytes of one Arrow batch handed to a Python worker; array code needs about forty times that.
BATCH_BYTES = 2 << 20

# Parts that a table too wide to be dealt out at once is cut into.
SLICES = 8

# UTF-8 bytes that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODES = np.random.default_rng(20240917).integers(1, 1 << 63, 256).astype(np.uint64)
_powers: dict[int, np.ndarray] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of this package's plans: those of the library, and small Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # operators of several jobs store what they hand on, so shuffle files can go with their job
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def release(*tables: DataFrame) -> None:
    """Drop stored tables that nothing reads any more."""
    for stored in tables:
        for folder in {f.rsplit("/", 1)[0] for f in stored.inputFiles()}:
            delete_path(stored.sparkSession, folder)


def in_turn(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """The parts stored as one table, one after the other: the shuffle files of one at a time lie on the disk."""
    path = None
    for part in parts:
        path = path or scratch_path(part.sparkSession, name)
        part.write.mode("append").parquet(path)
    return part.sparkSession.read.schema(part.schema).parquet(path)


def slice_number(key: str, slices: int = SLICES) -> Column:
    """Number of the slice that a row is in by a hash of ``key``; equal keys are in one slice."""
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")


def in_slices(rows: DataFrame, key: str, name: str, step: Callable[[DataFrame], DataFrame], slices: int = SLICES) -> DataFrame:
    """Stored ``step(slice)`` of all slices of ``rows`` by ``key``, as one table.

    The rows are stored once, by slice, and a slice is dropped when it is done.
    """
    spark = rows.sparkSession
    stored = scratch_path(spark, f"{name}-slices")
    dealt = rows.withColumn("slice", slice_number(key, slices))
    dealt.write.partitionBy("slice").parquet(stored)

    def parts() -> Iterator[DataFrame]:
        for i in range(slices):
            yield step(spark.read.schema(dealt.schema).parquet(stored).where(F.col("slice") == i).drop("slice"))
            delete_path(spark, f"{stored}/slice={i}")

    return in_turn(parts(), name)


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) of every row; other columns, whatever their names, are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def pieces(batches: Iterator[pa.RecordBatch], most_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts (second column) hold about ``most_bytes``, at least one row each."""
    for batch in batches:
        sizes = np.diff(offsets_of(batch.column(1)))
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def offsets_of(column: pa.Array) -> np.ndarray:
    """Byte offsets of the strings of a column; a null counts as empty."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    whole = np.frombuffer(column.buffers()[1], dtype=kind)
    return whole[column.offset : column.offset + len(column) + 1].astype(np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column of strings; offsets start at 0 and nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    offsets = offsets_of(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def power(base: int, n: int) -> np.ndarray:
    """base ** (0 .. n-1) modulo 2 ** 64; kept by the worker and lengthened when needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        full = np.full(max(n, 1 << 16), np.uint64(base), dtype=np.uint64)
        full[0] = 1
        have = _powers[base] = np.multiply.accumulate(full)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slice_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of codes[starts:ends] for each pair, equal for equal slices wherever they lie."""
    return next(many_slice_hashes(codes, [(starts, ends)], seed))


def many_slice_hashes(
    codes: np.ndarray, slices: list[tuple[np.ndarray, np.ndarray]], seed: int = 0
) -> Iterator[np.ndarray]:
    """``slice_hashes`` for several (starts, ends) of the same codes, from one running sum."""
    base = int(_BASE) ^ (seed << 1)
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * power(base, len(codes)), out=total[1:], dtype=np.uint64)
    inverse = power(pow(base, -1, 1 << 64), len(codes) + 1)
    for starts, ends in slices:
        value = (total[ends] - total[starts]) * inverse[starts]
        yield mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(seed))


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """``slice_hashes`` of every ``n`` codes in a row."""
    base = int(_BASE)
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * power(base, len(codes)), out=total[1:], dtype=np.uint64)
    value = total[n:] - total[:-n]
    value *= power(pow(base, -1, 1 << 64), len(codes) + 1)[: len(value)]
    return mix(value + np.uint64(n * 0xD1B54A32D192ED03 % (1 << 64)))


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of each maximal run of bytes that separate nothing, within one text."""
    n = len(data)
    inside = ~separators[data]
    first = np.zeros(n + 1, dtype=bool)  # a text begins here
    first[offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    return np.flatnonzero(inside & (~before | first[:n])), np.flatnonzero(inside & (~after | first[1:])) + 1


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def slice_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word, index of the first word of each text and an end mark)."""
    starts, ends = word_bounds(data, offsets, separators)
    return slice_hashes(byte_codes(lower(data)), starts, ends), np.searchsorted(starts, offsets)


def byte_codes(data: np.ndarray) -> np.ndarray:
    """A 64-bit code for each byte."""
    return _BYTE_CODES[data]
