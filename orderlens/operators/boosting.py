"""Gradient-boosted trees on bin numbers, many fits in the same passes over the rows.

Rows are turned into bin numbers once and stored in blocks.  A pass reads every block, sums gradients by
(fit, node, feature, bin) and hands a fixed number of sums to the driver, which chooses the splits; so a
level of a tree costs one pass, whether one fit is made or all trials on all folds.  Below the root only the
lighter child of a split is summed; its sibling is the rest of the parent.  The rows keep their
margins from round to round, and the first pass of a round also counts right and wrong labels of held-out
rows: the F1 of every smaller number of rounds comes with the fit of the largest.

Gradients are rounded to whole multiples of a power of two that lets their sums stay exact, so a tree does
not depend on partitions, on the order of sums or on the other fits of the pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import delete_path, materialize, scratch_path, small_table

MAX_BINS = 64
MOST_SUMS = 4_000_000  # sums of one pass; more fits than that are made one part after the other
ROWS_OF_A_TASK = 20_000  # at least, where the stored files allow it
STORED_EVERY = 25  # rounds after which margins are written to the shared folder
BLOCK = "bins binary, label binary, fold binary, key binary"


@dataclass(frozen=True)
class Setting:
    """What a boosted model is made with."""

    depth: int = 6
    rate: float = 0.3
    rounds: int = 100
    row_share: float = 1.0  # of the rows, drawn for each tree
    column_share: float = 1.0  # of the features, drawn for each tree
    least_weight: float = 1.0  # sum of second derivatives that each side of a split must have
    gamma: float = 0.0  # gain that a split must have, unless one below it has
    ridge: float = 1.0

    @classmethod
    def of(cls, params: dict | None) -> "Setting":
        names = {
            "maxDepth": "depth", "stepSize": "rate", "maxIter": "rounds", "subsamplingRate": "row_share",
            "featureSubsetStrategy": "column_share", "minChildWeight": "least_weight", "gamma": "gamma",
            "regLambda": "ridge",
        }
        unknown = set(params or {}) - set(names)
        if unknown:
            raise ValueError(f"boosted trees have no settings {sorted(unknown)}")
        kinds = {"depth": int, "rounds": int}
        return cls(**{names[k]: kinds.get(names[k], float)(v) for k, v in (params or {}).items()})


@dataclass
class Fit:
    """One model to be made: its setting, the fold it must not see, the features it may use."""

    setting: Setting
    columns: tuple[int, ...]
    positive_weight: float = 1.0
    held_out: int | None = None
    seed: int = 0
    trees: list["Tree"] = field(default_factory=list)
    counts: list[tuple[int, int, int]] = field(default_factory=list)  # (tp, fp, fn) held out, by rounds from 0

    def f1(self, rounds: int | None = None) -> float:
        """F1 on the held-out rows of the model's first ``rounds`` trees."""
        tp, fp, fn = self.counts[-1 if rounds is None else rounds]
        return 2 * tp / (2 * tp + fp + fn) if tp else 0.0

    def columns_of(self, number: int) -> np.ndarray:
        """The features that a tree may use."""
        share = self.setting.column_share
        if share >= 1:
            return np.array(self.columns)
        n = max(1, int(len(self.columns) * share))
        return np.sort(np.random.default_rng([self.seed, number]).choice(self.columns, n, replace=False))


class Tree:
    """A tree in growth, as a heap: children of node i are 2 i + 1 and 2 i + 2."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.feature = np.full(size, -1)
        self.bin = np.zeros(size, np.int64)
        self.gain = np.zeros(size)
        self.cover = np.zeros(size)
        self.value = np.zeros(size)
        self.open = np.zeros(size, bool)
        self.open[0] = True

    def walk(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node that each row has come to."""
        n = bins.shape[1]
        at, rows, flat = np.zeros(n, np.int64), np.arange(n), bins.reshape(-1)
        nodes, split = np.arange(len(self.feature)), self.feature >= 0
        place = np.where(split, self.feature, 0) * n
        cut = np.where(split, self.bin, 255).astype(np.uint8)  # no bin is above 255, so a leaf keeps its rows
        left = np.where(split, 2 * nodes + 1, nodes)
        for _ in range(levels):
            right = flat.take(place.take(at) + rows) > cut.take(at)
            at = left.take(at) + right
        return at

    def lighter(self, level: int) -> np.ndarray:
        """Of each node above the level that is open below: the child with less cover, which is summed."""
        parents = np.arange(2 ** (level - 1) - 1, 2**level - 1)
        parents = parents[self.open[2 * parents + 1]]
        return 2 * parents + 1 + (self.cover[2 * parents + 2] < self.cover[2 * parents + 1])


@dataclass
class BinnedRows:
    """Blocks of (bins by feature, label, fold, key of the row), and the upper edges of the bins."""

    features: list[str]
    edges: list[np.ndarray]
    blocks: object
    n: int

    @property
    def width(self) -> int:
        return max((len(e) for e in self.edges), default=0) + 1

    def release(self) -> None:
        self.blocks.unpersist()


def bin_rows(df: DataFrame, features: list[str], label: str, fold: str | None = None, id_column: str = "order_id",
             max_bins: int = MAX_BINS) -> BinnedRows:
    """Bin numbers of all rows, stored; two passes.  A missing number fails.

    Edges are quantiles from a sketch, at most ``max_bins - 1`` a feature, whatever the number of rows.
    """
    spark = df.sparkSession
    shares = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
    sketches = [F.percentile_approx(F.col(f).cast("double"), shares, F.lit(10_000)).alias(f) for f in features]
    found = df.agg(*sketches).first()
    edges = [np.unique(np.array(found[f] or [], dtype=np.float64)) for f in features]

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = np.empty((len(features), batch.num_rows), np.uint8)
            for i, cut in enumerate(edges):
                values = batch.column(3 + i).to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isnan(values).any():
                    raise ValueError(f"{features[i]} lacks values; clean the rows first")
                bins[i] = np.searchsorted(cut, values)
            parts = [bins, *(batch.column(i).to_numpy().astype(t) for i, t in ((1, np.uint8), (2, np.int16), (0, np.int64)))]
            columns = [pa.array([p.tobytes()], pa.binary()) for p in parts]
            yield pa.RecordBatch.from_arrays(columns, ["bins", "label", "fold", "key"])

    known = [id_column] if id_column in df.columns else [label, *features]
    rows = df.select(
        F.xxhash64(*known).alias("_key"),
        F.col(label).cast("int").alias("_label"),
        (F.col(fold) if fold else F.lit(-1)).cast("int").alias("_fold"),
        *[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)],
    )
    stored = materialize(rows.mapInArrow(block, BLOCK), "binned")
    n = stored.agg(F.sum(F.length("label"))).first()[0] or 0
    if not n:
        raise ValueError("there are no rows to train on")
    tasks, width = -(-n // ROWS_OF_A_TASK), len(features)

    def arrays(row) -> tuple:
        bins = np.frombuffer(row.bins, np.uint8).reshape(width, -1)
        label = np.frombuffer(row.label, np.uint8)
        return bins, label, np.frombuffer(row.fold, np.int16), np.frombuffer(row.key, np.int64)

    read = stored.rdd if stored.rdd.getNumPartitions() <= tasks else stored.rdd.coalesce(tasks)
    # Blocks are small files of a few passes' worth of work; an RDD spares planning a query for each pass.
    blocks = read.map(arrays).persist(StorageLevel.MEMORY_AND_DISK)
    return BinnedRows(list(features), edges, blocks, n)


def _drawn(key: np.ndarray, fit: Fit, number: int) -> np.ndarray:
    """Whether each row takes part in a tree, by its key."""
    x = key.astype(np.uint64) ^ np.uint64((fit.seed * 1_000_003 + number + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) < np.uint64(min(int(fit.setting.row_share * 2.0**64), 2**64 - 1))


def _sums(block: tuple, fits: list[Fit], trees: list[Tree], number: int, level: int, width: int, unit: float) -> np.ndarray:
    """Gradient and second derivative by (fit, feature, node of the level that is summed, bin), one after the other."""
    bins, label, fold, key, margins = block
    out = []
    for fit, tree, margin in zip(fits, trees, margins):
        first, n_nodes = 2**level - 1, 2**level
        if level >= fit.setting.depth or not tree.open[first : first + n_nodes].any():
            continue
        wanted = tree.lighter(level) if level else np.zeros(1, np.int64)
        asked = np.full(len(tree.feature), -1)
        asked[wanted] = np.arange(len(wanted)) * width
        base = asked.take(tree.walk(bins, level))
        used = base >= 0
        if fit.held_out is not None:
            used &= fold != fit.held_out
        used = np.flatnonzero(used)
        if fit.setting.row_share < 1:
            used = used[_drawn(key[used], fit, number)]
        p = 1 / (1 + np.exp(-margin[used].astype(np.float64)))
        y = label[used]
        weight = np.where(y == 1, fit.positive_weight, 1.0)
        gradient, second = np.rint((p - y) * weight * unit), np.rint(p * (1 - p) * weight * unit)
        base = base[used]
        for f in fit.columns_of(number):
            place = base + bins[f].take(used)
            for values in (gradient, second):
                out.append(np.bincount(place, weights=values, minlength=len(wanted) * width))
    return np.concatenate(out) if out else np.zeros(0)


def _with_siblings(tree: Tree, found: np.ndarray, above: np.ndarray | None, level: int) -> np.ndarray:
    """Sums (feature, gradient or second, node, bin) of a level from those of the lighter children.

    ``above`` holds the level before.  All are whole numbers that floats hold exactly, so a difference is as
    exact as a sum.
    """
    if not level:
        return found
    first = 2**level - 1
    summed = tree.lighter(level)
    other = summed + np.where(summed % 2, 1, -1)  # left children have odd numbers
    out = np.zeros((*found.shape[:2], 2**level, found.shape[3]))
    out[:, :, summed - first] = found
    out[:, :, other - first] = above[:, :, (summed - 1) // 2 - (2 ** (level - 1) - 1)] - found
    return out


def _counts(block: tuple, fits: list[Fit]) -> np.ndarray:
    """(tp, fp, fn) of each fit on its held-out rows."""
    _, label, fold, _, margins = block
    out = np.zeros((len(fits), 3))
    for i, (fit, margin) in enumerate(zip(fits, margins)):
        if fit.held_out is not None:
            seen = fold == fit.held_out
            said, y = margin[seen] > 0, label[seen] == 1
            out[i] = (said & y).sum(), (said & ~y).sum(), (~said & y).sum()
    return out.ravel()


def _grow(fit: Fit, tree: Tree, sums: np.ndarray, columns: np.ndarray, level: int) -> None:
    """Split the open nodes of a level; ``sums`` is (feature, gradient or second, node, bin)."""
    s, first = fit.setting, 2**level - 1
    left = sums.cumsum(axis=3)
    total = left[0, :, :, -1]  # (gradient or second, node)
    if level == 0:
        tree.cover[0], tree.value[0] = total[1, 0], -total[0, 0] / (total[1, 0] + s.ridge)
    right = total[None, :, :, None] - left

    def part(x: np.ndarray) -> np.ndarray:
        return x[:, 0] ** 2 / (x[:, 1] + s.ridge)

    whole = total[0] ** 2 / (total[1] + s.ridge)
    gain = part(left) + part(right) - whole[None, :, None]
    least = max(s.least_weight, 1e-12)
    gain[(left[:, 1] < least) | (right[:, 1] < least)] = -np.inf
    for node in np.flatnonzero(tree.open[first : first + 2**level]):
        f, cut = np.unravel_index(gain[:, node].argmax(), gain[:, node].shape)
        i = first + node
        tree.open[i] = False
        if gain[f, node, cut] <= 1e-6:
            continue
        tree.feature[i], tree.bin[i], tree.gain[i] = columns[f], cut, gain[f, node, cut]
        for child, side in ((2 * i + 1, left), (2 * i + 2, right)):
            g, h = side[f, 0, node, cut], side[f, 1, node, cut]
            tree.cover[child], tree.value[child] = h, -g / (h + s.ridge)
            tree.open[child] = level + 1 < s.depth


def _finish(fit: Fit, tree: Tree) -> None:
    """Take back weak splits that have no stronger one below, and scale the leaves."""
    for i in range(len(tree.feature) // 2 - 1, -1, -1):
        if tree.feature[i] >= 0 and tree.gain[i] < fit.setting.gamma:
            if tree.feature[2 * i + 1] < 0 and tree.feature[2 * i + 2] < 0:
                tree.feature[i] = -1
    tree.open[:] = False
    tree.value = (tree.value * fit.setting.rate).astype(np.float32)
    fit.trees.append(tree)


def fit_together(rows: BinnedRows, fits: list[Fit], spark: SparkSession) -> int:
    """Make all fits, in as few passes as the deepest with the most rounds needs; returns the passes made."""
    deepest = max((f.setting.depth for f in fits), default=1)
    sums = 2**deepest * rows.width * len(rows.features)
    size = max(1, MOST_SUMS // max(1, sums))
    return sum(_fit_part(rows, fits[i : i + size], spark) for i in range(0, len(fits), size))


def _fit_part(rows: BinnedRows, fits: list[Fit], spark: SparkSession) -> int:
    weight = max(1.0, *(f.positive_weight for f in fits))
    unit = 2.0 ** min(40, math.floor(52 - math.log2(max(1, rows.n) * weight)))
    width, passes = rows.width, 0
    active = sorted(fits, key=lambda f: -f.setting.rounds)  # a fit that is done leaves the end of the margins

    def begin(block: tuple) -> tuple:
        return (*block, np.zeros((len(fits), len(block[1])), np.float32))

    state = rows.blocks.map(begin).persist(StorageLevel.MEMORY_AND_DISK)
    before, folder = None, None
    try:
        for number in range(max((f.setting.rounds for f in fits), default=0) + 1):
            counted, active = active, [f for f in active if f.setting.rounds > number]
            trees = [Tree(f.setting.depth) for f in active]
            above: list[np.ndarray | None] = [None] * len(trees)
            for level in range(max((f.setting.depth for f in active), default=1)):
                if level and not any(t.open.any() for t in trees):
                    break
                found = _pass(state, active, trees, number, level, width, unit, counted if level == 0 else None)
                passes += 1
                if level == 0:
                    for i, fit in enumerate(counted):
                        fit.counts.append(tuple(int(x) for x in found[3 * i : 3 * i + 3]))
                    found = found[3 * len(counted) :]
                    if before is not None:
                        before.unpersist()
                at = 0
                for i, (fit, tree) in enumerate(zip(active, trees)):
                    if level < fit.setting.depth and tree.open[2**level - 1 : 2 ** (level + 1) - 1].any():
                        columns = fit.columns_of(number)
                        shape = (len(columns), 2, len(tree.lighter(level)) if level else 1, width)
                        n = math.prod(shape)
                        above[i] = _with_siblings(tree, found[at : at + n].reshape(shape), above[i], level)
                        _grow(fit, tree, above[i] / unit, columns, level)
                        at += n
            if not active:
                break
            for fit, tree in zip(active, trees):
                _finish(fit, tree)
            before, state = state, state.map(_stepper(trees)).persist(StorageLevel.MEMORY_AND_DISK)
            if (number + 1) % STORED_EVERY == 0:
                old, folder = folder, scratch_path(spark, "margins")
                state.saveAsPickleFile(folder)
                before.unpersist()
                state.unpersist()
                before, state = None, spark.sparkContext.pickleFile(folder).persist(StorageLevel.MEMORY_AND_DISK)
                if old:
                    state.count()
                    delete_path(spark, old)
    finally:
        state.unpersist()
        if folder:
            delete_path(spark, folder)
    return passes


def _stepper(trees: list[Tree]):
    def step(block: tuple) -> tuple:
        bins, label, fold, key, margins = block
        moved = [m + t.value[t.walk(bins, _depth(t))].astype(np.float32) for m, t in zip(margins, trees)]
        return bins, label, fold, key, np.array(moved, np.float32)

    return step


def _depth(tree: Tree) -> int:
    return (len(tree.feature) + 1).bit_length() - 2


def _pass(state, fits, trees, number, level, width, unit, counted) -> np.ndarray:
    fits = [replace(f, trees=[], counts=[]) for f in fits]  # what is made already does not travel
    counted = counted and [replace(f, trees=[], counts=[]) for f in counted]

    def read(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        total = None
        for block in blocks:
            found = _sums(block, fits, trees, number, level, width, unit)
            if counted is not None:
                found = np.concatenate([_counts(block, counted), found])
            total = found if total is None else total + found
        if total is not None:
            yield total

    partial = state.mapPartitions(read)
    # sums of many tasks meet on the executors first
    return partial.treeReduce(np.add, depth=1 if state.getNumPartitions() <= 16 else 2)


class BoostedModel:
    """Fitted trees over raw feature values."""

    def __init__(self, features: list[str], trees: list[dict]):
        self.features = list(features)
        self.trees = trees  # feature, threshold, value, gain, cover: heaps as lists

    @classmethod
    def of(cls, rows: BinnedRows, fit: Fit, rounds: int | None = None) -> "BoostedModel":
        trees = []
        for t in fit.trees[:rounds]:
            cuts = [float(rows.edges[f][b]) if f >= 0 else 0.0 for f, b in zip(t.feature, t.bin)]
            trees.append({"feature": t.feature.tolist(), "threshold": cuts, "value": t.value.tolist(),
                          "gain": t.gain.tolist(), "cover": t.cover.tolist()})
        return cls(rows.features, trees)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802  the name that Spark's tree models use
        """Mean gain of a feature's splits, as a share of the sum over features."""
        gain, splits = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in self.trees:
            for f, g in zip(tree["feature"], tree["gain"]):
                if f >= 0:
                    gain[f], splits[f] = gain[f] + g, splits[f] + 1
        mean = gain / np.maximum(splits, 1)
        return Vectors.dense(mean / mean.sum() if mean.sum() else mean)

    def predict(self, df: DataFrame, features: list[str]) -> DataFrame:
        """Adds ``prediction`` and ``probability``; the trees travel with the function, their size is rounds x nodes."""
        if list(features) != self.features:
            raise ValueError(f"the model was made with {self.features}")
        heaps = [(np.array(t["feature"]), np.array(t["threshold"]), np.array(t["value"], np.float32)) for t in self.trees]
        names = self.features

        def score(*columns):
            import pandas as pd

            values = np.stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns])
            if np.isnan(values).any():
                raise ValueError(f"features lack values: {names}")
            rows, margin = np.arange(values.shape[1]), np.zeros(values.shape[1], np.float32)
            for feature, threshold, value in heaps:
                at = np.zeros(values.shape[1], np.int64)
                for _ in range((len(feature) + 1).bit_length() - 2):
                    f = feature[at]
                    at = np.where(f >= 0, 2 * at + 1 + (values[f, rows] > threshold[at]), at)
                margin = margin + value[at]
            return pd.Series(margin.astype(np.float64))

        margin = F.pandas_udf(score, "double")(*[F.col(f).cast("double") for f in features])
        scored = df.select("*", margin.alias("_margin"))
        return scored.select(
            *df.columns,
            (F.col("_margin") > 0).cast("int").alias("prediction"),
            (1 / (1 + F.exp(-F.col("_margin")))).alias("probability"),
        )

    def save(self, path: str) -> None:
        """Every node of every tree as a row, and the feature names."""
        spark = SparkSession.active()
        rows = [
            (i, n, *(tree[c][n] for c in ("feature", "threshold", "value", "gain", "cover")))
            for i, tree in enumerate(self.trees)
            for n in range(len(tree["feature"]))
        ]
        schema = "tree int, node int, feature int, threshold double, value double, gain double, cover double"
        small_table(spark, rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        names = list(enumerate(self.features))
        small_table(spark, names, "place int, name string").write.mode("overwrite").parquet(f"{path}/features")

    @classmethod
    def load(cls, path: str) -> "BoostedModel":
        spark = SparkSession.active()
        names = spark.read.parquet(f"{path}/features").orderBy("place").collect()
        trees: dict[int, dict] = {}
        for row in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            tree = trees.setdefault(row["tree"], {c: [] for c in ("feature", "threshold", "value", "gain", "cover")})
            for c, values in tree.items():
                values.append(row[c])
        return cls([r["name"] for r in names], [trees[i] for i in sorted(trees)])
