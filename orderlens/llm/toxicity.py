"""A toxicity classifier whose score must not move when an identity term is swapped for another.

Logistic regression on the presence of words, fitted by proximal gradient steps.  Besides the
log loss and an L1 term the objective holds the mean squared change of the log odds between each
labelled text and its counterfactual, in which every identity term is replaced by the next term
of its group.  The weight of the L1 term is chosen on labelled rows set apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import WHITE, pieces, slice_words, texts, utf8

# Identity terms by language and kind; a term is swapped for the next of its line.
IDENTITY_TERMS = """
women men
woman man
female male
christians muslims jews hindus buddhists atheists
christian muslim jewish hindu buddhist atheist
gay straight lesbian bisexual
homosexual heterosexual
transgender cisgender
black white asian latino
africans europeans asians americans mexicans
immigrants natives refugees
disabled blind deaf
femmes hommes
femme homme
musulmans juifs chrétiens
frauen männer
frau mann
muslime juden christen
mujeres hombres
mujer hombre
musulmanes judíos cristianos
"""

BUCKETS = 1 << 18
# Words are runs of ASCII letters and digits and of all bytes of other characters.
_SEPARATORS = WHITE.copy()
_SEPARATORS[:128] = True
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    _SEPARATORS[_low:_high] = False


def held_out(doc_id: Column) -> Column:
    """Whether the row is kept from training: crc32 of the id as text, modulo 3, is 1; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each distinct word, row offsets) of the texts of a column."""
    data, offsets = utf8(column)
    hashes, firsts = slice_words(data, offsets, _SEPARATORS)
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(firsts))
    keys = np.unique(rows * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64))
    return keys % BUCKETS, np.searchsorted(keys, np.arange(len(offsets), dtype=np.int64) * BUCKETS)


def swaps() -> dict[int, int]:
    """Bucket of an identity term -> bucket of the term put in its place."""
    lines = [line.split() for line in IDENTITY_TERMS.split("\n") if line]
    flat = [t for line in lines for t in line]
    buckets, firsts = features(pa.array(flat))
    bucket = {t: int(buckets[firsts[i]]) for i, t in enumerate(flat)}
    return {bucket[t]: bucket[line[(i + 1) % len(line)]] for line in lines for i, t in enumerate(line)}


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(toxic, features) of at most about ``most`` labelled documents outside the held-out part.

    A document with several labels counts as toxic if one says so.  Which rows are taken is
    decided by a hash of the id, evenly over all of them.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = marks.count()
    if n > most:
        share = int(most / n * (1 << 30))
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            buckets, firsts = features(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(buckets.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(2), lists], ["toxic", "features"])

    # ``most`` rows of 12 bytes at most, so the hint is bounded by a parameter
    return texts(docs).join(F.broadcast(marks), "doc_id").mapInArrow(read, "toxic int, features array<int>")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most_rows: int = 20_000,
    kept_features: int = 2048,
    l1: tuple[float, ...] | float = (2e-4, 1e-4, 5e-5, 2e-5, 1e-5),
    counterfactual: float = 1.0,
    steps: int = 400,
) -> tuple[float, np.ndarray]:
    """(bias, weight of each bucket).

    At most about ``most_rows`` labelled rows reach the driver, as lists of word buckets.  The
    ``kept_features`` buckets with the clearest difference between the classes, and all buckets
    of identity terms, are fitted.  Of the weights ``l1`` of the L1 term that one is taken which,
    fitted without a fifth of these rows, has the least log loss on that fifth; equal texts lie
    on one side.  A single weight is taken as it is.  Without any labelled row every score is 0.5; with one class only, the smoothed
    share of it.
    """
    l1 = (l1,) if isinstance(l1, (int, float)) else l1
    rows = labelled_rows(docs, labels, most_rows).toArrow()
    y = rows.column("toxic").to_numpy().astype(np.float64)
    lists = rows.column("features").combine_chunks() if len(y) else pa.array([], pa.list_(pa.int32()))
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    index = lists.flatten().to_numpy(zero_copy_only=False)
    counts = np.diff(lists.offsets.to_numpy()) if len(y) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(y)), counts)
    weights = np.zeros(BUCKETS)
    prior = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(prior / (1 - prior)))
    if not 0 < y.sum() < len(y):
        return bias, weights

    n1, n0 = y.sum(), len(y) - y.sum()
    # a fifth of the rows, told by their words alone
    apart = np.bincount(row, weights=index, minlength=len(y)).astype(np.int64) % 5 == 0
    in1 = np.bincount(index, weights=y[row], minlength=BUCKETS)
    in0 = np.bincount(index, minlength=BUCKETS) - in1
    share = (in1 + in0) / len(y)
    chi = (in1 / n1 - in0 / n0) ** 2 / np.maximum(share * (1 - share), 1 / len(y))
    chi[in1 + in0 < 2] = 0
    pairs = swaps()
    kept = np.union1d(np.argsort(-chi, kind="stable")[:kept_features], np.array([*pairs, *pairs.values()]))
    place = np.full(BUCKETS, -1)
    place[kept] = np.arange(len(kept))
    use = place[index] >= 0
    row, col = row[use], place[index[use]]

    # difference of each text and its counterfactual
    swap = np.arange(len(kept))
    swap[[place[a] for a in pairs]] = [place[b] for b in pairs.values()]
    moved = swap[col] != col
    d_row = np.concatenate([row[moved], row[moved]])
    d_col = np.concatenate([col[moved], swap[col[moved]]])
    d_val = np.repeat([1.0, -1.0], moved.sum())

    n, m = len(y), len(kept)

    def forward(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=w[col], minlength=n)

    def change(w: np.ndarray) -> np.ndarray:
        return np.bincount(d_row, weights=w[d_col] * d_val, minlength=n)

    def curvature(v: np.ndarray) -> np.ndarray:
        out = np.bincount(col, weights=forward(v)[row], minlength=m) / (4 * n)
        return out + 2 * counterfactual / n * np.bincount(d_col, weights=change(v)[d_row] * d_val, minlength=m)

    v = np.random.default_rng(1).random(m)
    for _ in range(20):
        v /= np.linalg.norm(v)
        v = curvature(v)
    bound = 1.1 * np.linalg.norm(v) + 0.3

    def descend(used: np.ndarray, penalty: float, w: np.ndarray, b: float, rounds: int) -> tuple[np.ndarray, float]:
        """Accelerated proximal steps on the rows that are ``used``, from (w, b)."""
        total = used.sum()
        step = total / n / bound
        at, at_b, t = w.copy(), b, 1.0
        for _ in range(rounds):
            off = (1 / (1 + np.exp(-np.clip(forward(at) + at_b, -35, 35))) - y) * used
            gradient = np.bincount(col, weights=off[row], minlength=m) / total
            moves = (change(at) * used)[d_row] * d_val
            gradient += 2 * counterfactual / total * np.bincount(d_col, weights=moves, minlength=m)
            new = at - step * gradient
            new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
            new_b = at_b - step * float(off.sum() / total)
            nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
            at, at_b = new + (t - 1) / nt * (new - w), new_b + (t - 1) / nt * (new_b - b)
            w, b, t = new, new_b, nt
        return w, b

    def loss(w: np.ndarray, b: float) -> float:
        odds = np.clip(forward(w) + b, -35, 35)
        return float(np.mean((np.logaddexp(0, odds) - y * odds)[apart]))

    w, b, chosen = np.zeros(m), bias, max(l1)
    if len(l1) > 1 and 0 < y[apart].sum() < apart.sum() and 0 < y[~apart].sum() < (~apart).sum():
        losses = {}
        for penalty in sorted(l1, reverse=True):  # each begins where the one before ended
            w, b = descend(~apart, penalty, w, b, steps // 2)
            losses[penalty] = loss(w, b)
        chosen = min(losses, key=losses.get)
    w, b = descend(np.ones(n, dtype=bool), chosen, w, b, steps)
    weights[kept] = w
    return b, weights


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **settings) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, from its whole text only.

    ``predicted`` is 1 if the score is at least ``threshold``.  A null or empty text has no word
    and gets the score of the bias alone.  Null ids are scored, never trained on and not held
    out; repeated rows are each scored; an empty table gives no rows; other columns are ignored.
    ``settings`` go to :func:`fit`.
    """
    spark = docs.sparkSession
    bias, weights = fit(docs, labels, **settings)
    model = spark.sparkContext.broadcast(weights.astype(np.float64))  # BUCKETS values, 2 MB

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            buckets, firsts = features(batch.column(1))
            total = np.concatenate([[0.0], np.cumsum(model.value[buckets])])
            odds = bias + np.round(total[firsts[1:]] - total[firsts[:-1]], 9)
            s = 1 / (1 + np.exp(-np.clip(odds, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = texts(docs).withColumn("held_out", held_out(F.col("doc_id")))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
