"""Exact quantiles with linear interpolation, for any number of distinct values."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.session import small_table

MOST_VALUES = 4096  # values of one bracket that are brought together


def unpivot(df: DataFrame, columns: list[str], name: str = "column_name", keep: list[str] = ()) -> DataFrame:
    """One (name, value) row per column, values as double."""
    doubles = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(list(keep), columns, name, "value")


@dataclass
class _Wanted:
    """One position of one column, and what is known of it: ``base`` values are at most ``low``, ``top`` are less
    than ``high`` (None: no bound), and the value at the position is between the two."""

    column: str
    share: float
    n: int
    base: int = 0
    top: int = 0
    low: float | None = None
    high: float | None = None
    value: float | None = None

    @property
    def left(self) -> int:
        return self.top - self.base

    @property
    def position(self) -> float:
        return self.share * (self.n - 1)

    @property
    def rank(self) -> int:
        return math.floor(self.position)

    def inside(self) -> Column:
        value, known = F.col(self.column), F.col(self.column).isNotNull()
        known = known if self.low is None else known & (value > F.lit(self.low))
        return F.when(known if self.high is None else known & (value < F.lit(self.high)), value)

    def narrow(self, edges: list[tuple[float, int, int]]) -> None:
        """Use (edge, values below it, values up to it), in ascending order."""
        for edge, below, up_to in edges:
            if below <= self.rank < up_to:
                self.value = edge
                return
            if self.rank < below:
                self.high, self.top = edge, below
                return
            self.low, self.base = edge, up_to


def exact_quantiles(df: DataFrame, columns: list[str], shares: list[float], accuracy: int = 10_000) -> DataFrame:
    """(column_name, share, value) for every column with values and every share.

    ``percentile`` would keep every distinct value of a column in one task.  Here a sketch brackets
    each position, one pass counts the values below and at the edges, which narrows the bracket
    exactly whatever the sketch's error, and so on inside it until at most ``MOST_VALUES`` values are left.
    Those are the only ones that are ever brought together.  A pass serves all columns and shares and copies no
    row; each shrinks the brackets by about ``accuracy / 6``, so a round more is needed for every
    thousandfold of rows.  Equal values, be it a third of all rows, are one edge.
    """
    spark = df.sparkSession
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    margin = 3.0 / accuracy

    def around(share: float) -> list[float]:
        return [max(share - margin, 0.0), min(share + margin, 1.0)]

    ends = [e for s in shares for e in around(s)]
    first = doubles.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.percentile_approx(c, ends, accuracy).alias(f"e{i}") for i, c in enumerate(columns)],
    ).first()
    wanted, brackets = [], []
    for i, c in enumerate(columns):
        for j, s in enumerate(shares):
            if first[f"n{i}"]:
                wanted.append(_Wanted(c, s, first[f"n{i}"], top=first[f"n{i}"]))
                brackets.append(sorted(set(first[f"e{i}"][2 * j : 2 * j + 2])))
    open_ = list(zip(wanted, brackets))
    while open_:
        sums = []
        for w, edges in open_:
            for e in edges:
                sums += [F.count_if(F.col(w.column) < F.lit(e)), F.count_if(F.col(w.column) <= F.lit(e))]
        counts = iter(_row(doubles, sums))
        for w, edges in open_:
            w.narrow([(e, next(counts), next(counts)) for e in edges])
        large = [w for w in wanted if w.value is None and w.left > MOST_VALUES]
        shares_left = [(w.rank - w.base) / max(1, w.left - 1) for w in large]
        sketches = [F.percentile_approx(w.inside(), around(s), accuracy) for w, s in zip(large, shares_left)]
        open_ = list(zip(large, [sorted(set(edges)) for edges in _row(doubles, sketches)])) if large else []
    few = [w for w in wanted if w.value is None]
    if few:
        for w, values in zip(few, _row(doubles, [F.sort_array(F.collect_list(w.inside())) for w in few])):
            w.value = values[w.rank - w.base]
    between = [w for w in wanted if w.position > w.rank]
    above = [(F.count_if(F.col(w.column) <= F.lit(w.value)), F.min(F.when(F.col(w.column) > F.lit(w.value), F.col(w.column))))
             for w in between]
    found = iter(_row(doubles, [x for pair in above for x in pair]) if between else [])
    rows = []
    for w in wanted:
        value = w.value
        if w.position > w.rank:
            up_to, following = next(found), next(found)
            second = value if w.rank + 1 < up_to else following
            value = value + (w.position - w.rank) * (second - value)
        rows.append((w.column, w.share, value))
    return small_table(spark, rows, "column_name string, share double, value double")


def _row(df: DataFrame, aggregates: list[Column]) -> list:
    return list(df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggregates)]).first())
