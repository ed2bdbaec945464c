"""Quality of documents by a linear-chain conditional random field over their lines.

Every line is good or bad.  What a line looks like, and what the lines beside it look like, speaks for
one or the other; a weight for each pair of neighbouring labels ties the lines together.  A document's
score is the share of its length that lies in good lines, by the marginals of forward-backward.

Labels are known for documents only, so in training all lines of a document carry its label.  Forward and
backward vectors of all lines of a batch come from prefix products of 2 x 2 matrices by doubling; the
first line of a document has a matrix of equal rows, which forgets what came before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import byte_codes, pieces, slice_hashes, texts, utf8, word_bounds
from orderlens.session import materialize

CHAIN = 64  # lines of a chain in training; a longer document becomes several
SLAB = 1 << 16  # lines whose features are in memory at once; it changes no result
_CLASSES = {
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": "0123456789",
    "space": " \t",
    "stop": ".,;:?'\"()-",
    "shout": "!",
    "bar": "|",
    "sign": "#$%&*+<=>@[]^_`{}~/\\",
}
_CLASS_OF = np.full(256, len(_CLASSES))  # all others: control characters and bytes of other scripts
for _i, _members in enumerate(_CLASSES.values()):
    _CLASS_OF[np.frombuffer(_members.encode(), np.uint8)] = _i
_KINDS = len(_CLASSES) + 1
OWN = 2 * _KINDS + 8  # features of a line by itself
FEATURES = 3 * OWN + 3


def held_out(doc_id: Column) -> Column:
    """Whether the row is kept from training: crc32 of the id as text is divisible by 5; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of each line, and the first line of each text and an end mark; an empty text has one line."""
    breaks = np.flatnonzero(data == 10)
    firsts = np.arange(len(offsets)) + np.searchsorted(breaks, offsets)
    n = int(firsts[-1])
    starts, ends = np.empty(n, np.int64), np.empty(n, np.int64)
    at = firsts[np.searchsorted(offsets, breaks, side="right") - 1]  # first line of the text of each break
    rank = np.arange(len(breaks)) - np.searchsorted(breaks, offsets)[np.searchsorted(offsets, breaks, side="right") - 1]
    starts[firsts[:-1]], ends[firsts[1:] - 1] = offsets[:-1], offsets[1:]
    starts[at + rank + 1], ends[at + rank] = breaks + 1, breaks
    return starts, ends, firsts


def own_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What each of some consecutive lines looks like by itself."""
    data, ends, starts = data[starts[0] : ends[-1]], ends - starts[0], starts - starts[0]
    n, sizes = len(starts), ends - starts
    own = np.zeros((n, OWN), np.float32)
    some = np.maximum(sizes, 1)
    kinds = _CLASS_OF[data]
    for k in range(_KINDS):
        total = np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int32)])
        share = (total[ends] - total[starts]) / some
        own[:, k], own[:, _KINDS + k] = share, np.sqrt(share)

    begin, stop = word_bounds(data, np.append(starts, len(data)))
    line = np.searchsorted(starts, begin, side="right") - 1
    hashes = slice_hashes(byte_codes(data), begin, stop)
    words = np.bincount(line, minlength=n)
    several = np.maximum(words, 1)
    again = np.zeros(len(line), bool)
    again[1:] = (line[1:] == line[:-1]) & (hashes[1:] == hashes[:-1])
    order = np.lexsort((hashes, line))
    new = np.ones(len(line), bool)
    new[1:] = (line[order][1:] != line[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    tail = kinds[stop - 1] if len(stop) else np.zeros(0, int)
    marked = (tail >= list(_CLASSES).index("shout")) & (tail < len(_CLASSES))  # words that end in !, | or a sign
    extra = own[:, 2 * _KINDS :]
    extra[:, 0] = np.log1p(sizes)
    extra[:, 1] = np.log1p(words)
    extra[:, 2] = np.minimum(sizes / several, 40) / 10
    extra[:, 3] = np.bincount(line, weights=again, minlength=n) / several
    extra[:, 4] = np.bincount(line[order], weights=new, minlength=n) / several
    extra[:, 5] = np.bincount(line, weights=marked, minlength=n) / several
    extra[:, 6] = sizes == 0
    full = sizes > 0
    extra[full, 7] = np.isin(data[ends[full] - 1], np.frombuffer(b".!?", np.uint8))
    return own


def _edges(firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line is the first, and the last, of its text."""
    first, last = np.zeros(firsts[-1], bool), np.zeros(firsts[-1], bool)
    first[firsts[:-1]], last[firsts[1:] - 1] = True, True
    return first, last


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of each line: its own, those of the line before and after, edges, 1; first line of each text)."""
    starts, ends, firsts = lines_of(data, offsets)
    out = np.zeros((len(starts), FEATURES), np.float32)
    own = out[:, :OWN] = own_features(data, starts, ends)
    first, last = _edges(firsts)
    out[1:, OWN : 2 * OWN] = np.where(first[1:, None], 0, own[:-1])
    out[:-1, 2 * OWN : 3 * OWN] = np.where(last[:-1, None], 0, own[1:])
    out[:, -3], out[:, -2], out[:, -1] = first, last, 1
    return out, firsts


def _prefix_sums(m: np.ndarray, longest: int) -> np.ndarray:
    """Column sums of the products of all matrices up to each one, scaled to sum 1."""
    span = 1
    while span < longest:
        left, right = m[:-span], m[span:]
        new = np.einsum("nij,njk->nik", left, right)
        new /= new.max(axis=(1, 2), keepdims=True)
        m = np.concatenate([m[:span], np.maximum(new, 1e-30)])
        span *= 2
    sums = m.sum(axis=1)
    return sums / sums.sum(axis=1, keepdims=True)


@dataclass
class Field:
    """Weights of a line's features for being bad, and of (label, next label)."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray

    def unary(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Log odds of each line by its features.  A line's part in its own odds and in its neighbours' is
        three numbers, so only ``SLAB`` lines have their features in memory."""
        w = self.weights / self.scale
        share = w[: 3 * OWN].reshape(3, OWN).T
        cuts = range(0, len(starts), SLAB)
        part = np.concatenate([own_features(data, starts[i : i + SLAB], ends[i : i + SLAB]) @ share for i in cuts])
        first, last = _edges(firsts)
        odds = part[:, 0] + w[-1] - self.center @ w + first * w[-3] + last * w[-2]
        odds[1:] += np.where(first[1:], 0, part[:-1, 1])
        odds[:-1] += np.where(last[:-1], 0, part[1:, 2])
        return odds


def marginals(unary: np.ndarray, firsts: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(probability that each line is bad, of each pair of labels at a line and the next, log of all sums).

    ``unary`` is the log odds of a bad line by its features, ``firsts`` the first line of each text and an
    end mark.  Pairs of a text's last line mean nothing.
    """
    n = len(unary)
    if not n:
        return np.zeros(0), np.zeros((0, 2, 2)), 0.0
    longest = int(np.diff(firsts).max())
    half = np.clip(unary, -24, 24) / 2
    own = np.exp(np.stack([-half, half], axis=1))  # good, bad
    steps = np.exp(pairs)[None] * own[:, None, :]
    steps[firsts[:-1]] = own[firsts[:-1], None, :]
    top = steps.max(axis=(1, 2), keepdims=True)
    ahead = _prefix_sums(steps / top, longest)
    back = np.ones_like(steps)
    back[:-1] = (steps / top)[1:]
    back[firsts[1:] - 1] = 1.0
    behind = _prefix_sums(back[::-1].transpose(0, 2, 1), longest)[::-1]
    both = ahead * behind
    bad = both[:, 1] / both.sum(axis=1)
    joint = np.zeros_like(steps)
    joint[:-1] = ahead[:-1, :, None] * steps[1:] * behind[1:, None, :]
    joint /= np.maximum(joint.sum(axis=(1, 2), keepdims=True), 1e-300)
    before = np.full((n, 2), 0.5)
    before[1:] = ahead[:-1]
    before[firsts[:-1]] = 0.5  # a first line has equal rows
    total = np.log((before[:, :, None] * steps).sum(axis=(1, 2))).sum()
    return bad, joint, float(total)


def _minimum(value, at: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """Where a smooth function is least, by limited-memory quasi-Newton steps; ``value`` gives it and its gradient."""
    f, g = value(at)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        d, kept = -g, []
        for s, y in reversed(moves):
            a = s @ d / (s @ y)
            kept.append(a)
            d = d - a * y
        if moves:
            s, y = moves[-1]
            d = d * (s @ y / (y @ y))
        for (s, y), a in zip(moves, reversed(kept)):
            d = d + (a - y @ d / (s @ y)) * s
        step, slope = 1.0 if moves else 1.0 / max(1.0, np.linalg.norm(g)), g @ d
        while True:
            new = at + step * d
            f2, g2 = value(new)
            if f2 <= f + 1e-4 * step * slope or step < 1e-8:
                break
            step /= 2
        if step < 1e-8 or f - f2 < 1e-7 * max(1.0, abs(f)):
            return new if f2 < f else at
        if (new - at) @ (g2 - g) > 1e-12:
            moves = [*moves, (new - at, g2 - g)][-memory:]
        at, f, g = new, f2, g2
    return at


def chains(docs: DataFrame, labels: DataFrame, most_documents: int, most_lines: int) -> DataFrame:
    """(label, key, lines, features) of chains of at most ``CHAIN`` lines of labelled documents not held out.

    Bad is 1; a document with several labels is bad if one says so.  At most about ``most_documents``
    documents and ``most_lines`` of their lines are taken, evenly by hashes of id and place.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((1 - F.min("quality")).alias("bad"))
    )
    n = marks.count()
    if n > most_documents:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(most_documents / n * (1 << 30)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows, firsts = features(*utf8(batch.column(1)))
            cuts = np.unique(np.concatenate([firsts, *(np.arange(a, b, CHAIN) for a, b in zip(firsts, firsts[1:]))]))
            text = np.searchsorted(firsts, cuts[:-1], side="right") - 1
            sizes = np.diff(cuts)
            ids = batch.column(0).to_numpy()[text]
            flat = pa.ListArray.from_arrays(pa.array((cuts * FEATURES).astype(np.int32)), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column(2).to_numpy()[text]),
                    pa.array(ids),
                    pa.array(cuts[:-1] - firsts[text]),
                    pa.array(sizes),
                    flat,
                ],
                ["bad", "doc_id", "place", "lines", "features"],
            )

    # the marks are bounded by a parameter
    wanted = texts(docs).join(F.broadcast(marks), "doc_id")
    found = wanted.mapInArrow(read, "bad int, doc_id long, place long, lines long, features array<float>")
    found = materialize(found, "quality-chains")
    lines = found.agg(F.sum("lines")).first()[0] or 0
    if lines > most_lines:
        key = F.pmod(F.xxhash64("doc_id", "place"), F.lit(1 << 30))
        found = found.where(key < int(most_lines / lines * (1 << 30)))
    return found


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most_documents: int = 6000,
    most_lines: int = 60_000,
    penalty: float = 1e-4,
    rounds: int = 60,
) -> Field:
    """The field that makes the labels of the chains likeliest, with a quadratic ``penalty`` on the weights.

    At most about ``most_lines`` lines of ``FEATURES`` numbers reach the driver.  Without any labelled
    row every line is as likely good as bad; with labels of one kind only it is nearly always of that kind.
    """
    rows = chains(docs, labels, most_documents, most_lines).toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("place", "ascending")]).combine_chunks()
    if not rows.num_rows:
        return Field(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), np.zeros((2, 2)))
    x = np.concatenate([c.flatten().to_numpy() for c in rows.column("features").chunks]).reshape(-1, FEATURES)
    sizes = rows.column("lines").to_numpy()
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    y = np.repeat(rows.column("bad").to_numpy(), sizes)
    center, scale = x.mean(axis=0, dtype=np.float64), x.std(axis=0, dtype=np.float64)
    center[-1], scale = 0.0, np.where(scale > 1e-6, scale, 1.0)
    z = (x - center) / scale
    last = firsts[1:] - 1
    inner = np.ones(len(y), bool)
    inner[last] = False
    met = np.zeros((2, 2))
    for label in (0, 1):
        met[label, label] = (inner & (y == label)).sum()
    n = len(y)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        unary, pairs = z @ w[:FEATURES], w[FEATURES:].reshape(2, 2)
        bad, joint, total = marginals(unary, firsts, pairs)
        said = (np.clip(unary, -24, 24) * (y - 0.5)).sum() + (met * pairs).sum()
        gradient = np.concatenate([z.T @ (bad - y), (joint[inner].sum(axis=0) - met).ravel()])
        return (total - said) / n + penalty / 2 * w @ w, gradient / n + penalty * w

    w = _minimum(loss, np.zeros(FEATURES + 4), rounds)
    return Field(center, scale, w[:FEATURES], w[FEATURES:].reshape(2, 2))


def scores_of(field: Field, column: pa.Array) -> np.ndarray:
    """Share of each text's length that lies in good lines; a line break belongs to the line it ends."""
    data, offsets = utf8(column)
    starts, ends, firsts = lines_of(data, offsets)
    good = 1 - marginals(field.unary(data, starts, ends, firsts), firsts, field.pairs)[0]
    weight = ends - starts + 1.0
    return np.clip(np.add.reduceat(good * weight, firsts[:-1]) / np.add.reduceat(weight, firsts[:-1]), 0, 1)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **settings) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, from its whole text only.

    ``predicted`` is 1 if the score is at least ``threshold``.  A null or empty text is one empty line.
    Null ids are scored, never trained on and not held out; repeated rows are each scored; an empty
    table gives no rows; other columns are ignored.  ``settings`` go to :func:`fit`.
    """
    field = fit(docs, labels, **settings)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            s = np.round(scores_of(field, batch.column(1)), 9)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = texts(docs).withColumn("held_out", held_out(F.col("doc_id")))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
