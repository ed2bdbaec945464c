"""Records of CSV files whose quoted fields hold line breaks, read by as many tasks as there are splits.

A line begins a record when the quotes before it in its file are even in number.  One scan counts the
quotes of every split, sums over the splits of a file say how each begins, and a second scan joins lines to
records while it streams through a split.  A record that crosses a border comes out in pieces, at most
two of a split, which meet by file and order.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.session import materialize

WHOLE, BEGIN, MIDDLE, END = range(4)
PIECES = "kind int, path string, start long, value string"
OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST"}


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the files below ``path`` as text columns named by their common header.

    Fields are quoted with ``"`` and doubled quotes; a quote inside an unquoted field is not understood and
    fails by its number of fields, as does any record that has not as many as the header.  Empty lines
    between records are skipped.  A file whose header ends in carriage return and line feed has them
    as one line feed in its fields.  The scans write nothing but one row for each split.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )
    # a split is read by one task, so the first value that an aggregate sees is its first line
    first = F.first(F.when(F.col("start") == 0, F.col("value")), ignorenulls=True)
    found = lines.groupBy("path", "start").agg(F.sum("quotes").alias("quotes"), first.alias("header"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    splits = found.select(
        "path",
        "start",
        (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"),
        F.max("header").over(whole).alias("header"),
        (F.sum("quotes").over(whole) % 2 == 1).alias("unclosed"),
    )
    splits = materialize(splits, "csv-splits")
    plain = F.regexp_replace(F.regexp_replace("header", "^\ufeff", ""), "\r$", "")
    crossed = F.bool_or(F.col("inside") | F.col("unclosed"))
    least, most, crossed = splits.agg(F.min(plain), F.max(plain), crossed).first()
    names = _names(least, most, path)
    known = splits.select("path", "start", "inside", F.coalesce(F.col("header").endswith("\r"), F.lit(False)).alias("cr"))
    # Broadcast bound: about a hundred bytes for each split of the input.  Lines must stay in their order.
    pieces = lines.join(F.broadcast(known), ["path", "start"]).select("path", "start", "inside", "cr", "quotes", "value")
    pieces = pieces.mapInArrow(join_lines, PIECES)
    records = pieces.where(F.col("kind") == WHOLE).select("value")
    if crossed:  # else no field lies across a border, and the pieces need not be looked for
        records = records.unionByName(_crossing(pieces))
    fields = ", ".join(f"c{i} string" for i in range(len(names)))
    parsed = records.where("value <> ''").select(F.from_csv("value", fields, OPTIONS).alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(name) for i, name in enumerate(names)])


def _names(least: str | None, most: str | None, path: str) -> list[str]:
    """The columns of the least and greatest header of all files."""
    if least is None or least != most:
        raise ValueError(f"{path} holds no header" if least is None else f"the files of {path} differ in their headers")
    if least.count('"') % 2:
        raise ValueError(f"the header of {path} is longer than a line")
    return next(csv.reader([least]))


def join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and the pieces of records that begin or end in another split."""
    now, held, inside, kind, skip = None, [], False, BEGIN, False

    def left_over() -> list[tuple]:
        return [(kind, *now, "\n".join(held))] if held else []

    for batch in batches:
        if not batch.num_rows:
            continue
        paths, starts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        values, quotes = batch.column(5), batch.column(4).to_numpy()
        turns = [i for i in range(1, len(paths)) if starts[i] != starts[i - 1] or paths[i] != paths[i - 1]]
        bounds = [0, *turns, len(paths)]
        for low, high in zip(bounds, bounds[1:]):
            out: list[tuple] = []
            if now != (paths[low], int(starts[low])):
                out += left_over()
                now, held = (paths[low], int(starts[low])), []
                inside, skip = batch.column(2)[low].as_py(), now[1] == 0
                kind = MIDDLE if inside else BEGIN
            text = values.slice(low, high - low)
            if batch.column(3)[low].as_py():
                text = pa.compute.replace_substring_regex(text, "\r$", "")
            after = (inside + np.cumsum(quotes[low:high])) % 2 == 1
            before = np.concatenate([[inside], after[:-1]])
            single = ~before & ~after
            if skip and len(single):
                single[0], skip = False, False  # the header
            for i in np.flatnonzero(before | after):
                held.append(text[i].as_py())
                if not before[i]:
                    kind = BEGIN
                if not after[i]:
                    out.append((END if kind == MIDDLE else WHOLE, *now, "\n".join(held)))
                    held, kind = [], BEGIN
            inside = bool(after[-1])
            yield _rows(out)
            plain = text.filter(pa.array(single))
            n = len(plain)
            yield pa.RecordBatch.from_arrays(
                [pa.array([WHOLE] * n, pa.int32()), pa.array([now[0]] * n, pa.string()),
                 pa.array([now[1]] * n, pa.int64()), plain],
                ["kind", "path", "start", "value"],
            )
    yield _rows(left_over())


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.string()]
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["kind", "path", "start", "value"])


def _crossing(pieces: DataFrame) -> DataFrame:
    """Records from pieces: at most one ends and one begins in a split, or the split lies inside a field."""
    later = (F.col("kind") != END).cast("int").alias("later")
    parts = pieces.where(F.col("kind") != WHOLE).select("path", "start", later, "kind", "value")
    order = Window.partitionBy("path").orderBy("start", "later")
    placed = parts.withColumn("number", F.count_if(F.col("kind") == BEGIN).over(order))
    lines = F.sort_array(F.collect_list(F.struct("start", "later", "value")))
    return placed.groupBy("path", "number").agg(F.array_join(lines["value"], "\n").alias("value")).select("value")
