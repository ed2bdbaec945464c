"""Boosted trees against a plain search over all splits, and the promises about shared passes."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.operators import boosting, models, sampling, selection

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = []
    for i in range(600):
        a, b, c = rng.randint(0, 9), rng.choice([0.5, 1.5, 2.5]), rng.randint(-3, 3)
        p = 0.75 if a > 6 or (b > 2 and c > 0) else 0.15
        data.append((f"o{i}", int(rng.random() < p), float(a), b, float(c), i % 4))
    return spark.createDataFrame(data, "order_id string, bad_score int, a double, b double, c double, fold int").cache()


@pytest.fixture(scope="module")
def binned(rows):
    return boosting.bin_rows(rows, FEATURES, "bad_score", "fold")


def fit_of(setting, held_out=None, columns=(0, 1, 2), weight=2.0):
    return boosting.Fit(setting, columns, weight, held_out, seed=7)


def plain_margins(x, y, seen, setting, weight, rounds):
    """Margins after each round, by trying every value of every feature in every node."""
    margin, out = np.zeros(len(y)), [np.zeros(len(y))]
    w = np.where(y == 1, weight, 1.0)

    def grow(rows, level, g, h):
        whole = g[rows].sum(), h[rows].sum()
        leaf = -whole[0] / (whole[1] + setting.ridge) * setting.rate
        best = (1e-6, None, None)
        if level < setting.depth:
            for f in range(x.shape[1]):
                for cut in np.unique(x[:, f]):
                    left = rows[x[rows, f] <= cut]
                    gl, hl = g[left].sum(), h[left].sum()
                    gr, hr = whole[0] - gl, whole[1] - hl
                    if hl < setting.least_weight or hr < setting.least_weight:
                        continue
                    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - whole[0] ** 2 / (whole[1] + 1)
                    if gain > best[0] + 1e-9:
                        best = (gain, f, cut)
        if best[1] is None:
            return ("leaf", leaf)
        below = x[rows, best[1]] <= best[2]
        children = grow(rows[below], level + 1, g, h), grow(rows[~below], level + 1, g, h)
        if best[0] < setting.gamma and children[0][0] == children[1][0] == "leaf":
            return ("leaf", leaf)
        return ("split", best[1], best[2], *children)

    def value(node, row):
        while node[0] == "split":
            node = node[3] if row[node[1]] <= node[2] else node[4]
        return node[1]

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = grow(np.flatnonzero(seen), 0, (p - y) * w, p * (1 - p) * w)
        margin = margin + np.array([value(tree, row) for row in x])
        out.append(margin)
    return out


@pytest.mark.parametrize("gamma", [0.0, 4.0])
def test_trees_equal_a_search_over_all_splits(spark, rows, binned, gamma):
    data = rows.orderBy("order_id").toPandas()
    x, y, fold = data[FEATURES].to_numpy(), data.bad_score.to_numpy(), data.fold.to_numpy()
    setting = boosting.Setting(depth=3, rate=0.4, rounds=4, least_weight=2.0, gamma=gamma)
    fit = fit_of(setting, held_out=1)
    boosting.fit_together(binned, [fit], spark)
    want = plain_margins(x, y, fold != 1, setting, 2.0, 4)
    model = boosting.BoostedModel.of(binned, fit)
    got = model.predict(rows, FEATURES).orderBy("order_id").toPandas()
    assert np.allclose(got.probability, 1 / (1 + np.exp(-want[-1])), atol=1e-5)
    for rounds, margin in enumerate(want):
        said, bad, held = margin > 1e-9, y == 1, fold == 1
        cells = tuple(int((held & m).sum()) for m in (said & bad, said & ~bad, ~said & bad))
        assert fit.counts[rounds] == cells


def test_first_rounds_of_a_fit_are_the_shorter_fit(spark, binned):
    """Also with rows and features drawn for each tree, and whatever else is made in the same passes."""
    setting = boosting.Setting(depth=3, rate=0.3, rounds=9, row_share=0.7, column_share=0.67)
    long = [fit_of(setting, held_out=f) for f in range(4)]
    other = fit_of(boosting.Setting(depth=2, rounds=5), held_out=2, columns=(0, 2))
    boosting.fit_together(binned, [*long, other], spark)
    for rounds in (1, 4, 9):
        short = fit_of(boosting.replace(setting, rounds=rounds), held_out=2)
        boosting.fit_together(binned, [short], spark)
        assert short.counts == long[2].counts[: rounds + 1] and short.f1() == long[2].f1(rounds)
        same = [boosting.BoostedModel.of(binned, f, rounds).trees for f in (short, long[2])]
        assert same[0] == same[1]
    assert {f for t in other.trees for f in t.feature} <= {-1, 0, 2}


def test_partitions_and_stored_margins_change_nothing(spark, rows, binned, monkeypatch):
    setting = boosting.Setting(depth=3, rounds=7, row_share=0.8)
    want = fit_of(setting, held_out=0)
    boosting.fit_together(binned, [want], spark)
    monkeypatch.setattr(boosting, "STORED_EVERY", 2)
    monkeypatch.setattr(boosting, "ROWS_OF_A_TASK", 50)
    monkeypatch.setattr(boosting, "MOST_SUMS", 1)  # one fit at a time
    spread = boosting.bin_rows(rows.repartition(13), FEATURES, "bad_score", "fold")
    again = [fit_of(setting, held_out=0), fit_of(setting, held_out=1)]
    boosting.fit_together(spread, again, spark)
    assert again[0].counts == want.counts
    assert boosting.BoostedModel.of(spread, again[0]).trees == boosting.BoostedModel.of(binned, want).trees


def test_trials_and_folds_share_their_passes(spark, rows):
    """As many passes for twenty trials on four folds as for the longest fit alone."""
    space = {"maxIter": ("int", 2, 6), "maxDepth": ("int", 3, 3), "stepSize": ("log", 0.1, 0.5)}
    found = models.tune(rows.drop("fold"), "xgb", FEATURES, 20, 4, space=space)
    drawn = models.search_space("xgb", 20, space=space)
    assert len({(p["stepSize"]) for p in drawn}) == 4 and len({p["maxIter"] for p in drawn}) > 2
    assert found["passes"] <= 3 * max(p["maxIter"] for p in drawn) + 1
    scores = {(r["trial"], r["fold"]): r["f1"] for r in found["trials"].collect()}
    assert len(scores) == 80
    folded = sampling.stratified_folds(rows.drop("fold"), 4)
    for trial, fold in ((3, 1), (17, 2)):
        weights = models.class_weights(rows, "xgb")
        alone, _ = models.fold_f1(folded, fold, "xgb", FEATURES, drawn[trial], sampling.SEED, weights)
        assert abs(alone - scores[trial, fold]) < 0.03  # its bins come from the other folds only


def test_elimination_follows_separate_fits(spark, rows):
    params = {"maxIter": 3, "maxDepth": 2}
    wide = rows.drop("fold").withColumn("d", F.col("a") * 0 + F.length("order_id")).withColumn("e", -F.col("c"))
    names = [*FEATURES, "d", "e"]
    selector = selection.Selector(n_folds=5, params=params).fit(wide, names)
    assert selector.passes <= 5 * (3 * 2 + 1)
    weight = models.positive_weight(models.class_weights(wide, "xgb"))
    folded = sampling.stratified_folds(wide, 5)
    table = boosting.bin_rows(folded, names, "bad_score", "fold")
    want = {}
    for fold in range(5):
        kept = list(range(len(names)))
        while kept:
            fit = boosting.Fit(boosting.Setting.of(params), tuple(kept), weight, fold, sampling.SEED)
            boosting.fit_together(table, [fit], spark)
            want[len(kept), fold] = fit.f1()
            kept = selection._without_least(kept, boosting.BoostedModel.of(table, fit))
    got = {(r["n_features"], r["fold"]): r["f1"] for r in selector.cv_results.collect()}
    assert got == want and "a" in selector.features_to_keep_


def test_only_the_lighter_child_of_a_split_is_summed():
    rng = np.random.default_rng(3)
    n, width = 500, 8
    bins = rng.integers(0, width, (2, n)).astype(np.uint8)
    label, fold = rng.integers(0, 2, n).astype(np.uint8), (np.arange(n) % 3).astype(np.int16)
    margin = rng.normal(size=(1, n)).astype(np.float32)
    block = (bins, label, fold, np.arange(n), margin)
    fit = boosting.Fit(boosting.Setting(depth=3, least_weight=0.0), (0, 1), 2.0, held_out=1)
    tree, unit, above = boosting.Tree(3), 2.0**30, None
    p = 1 / (1 + np.exp(-margin[0].astype(np.float64)))
    gradient = np.rint((p - label) * np.where(label == 1, 2.0, 1.0) * unit)
    for level in range(3):
        found = boosting._sums(block, [fit], [tree], 0, level, width, unit)
        n_summed = found.size // (2 * 2 * width)
        assert n_summed == (1 if level == 0 else tree.open[2**level - 1 : 2 ** (level + 1) - 1].sum() // 2)
        above = boosting._with_siblings(tree, found.reshape(2, 2, n_summed, width), above, level)
        at = tree.walk(bins, level)
        for node in np.flatnonzero(tree.open):
            seen = (at == node) & (fold != 1)
            for f in range(2):
                want = np.bincount(bins[f, seen], weights=gradient[seen], minlength=width)
                assert above[f, 0, node - (2**level - 1)].tolist() == want.tolist()
        boosting._grow(fit, tree, above / unit, np.array([0, 1]), level)


def test_save_and_load(spark, rows, tmp_path):
    model = models.train(rows, "xgb", FEATURES, {"maxIter": 3, "maxDepth": 3, "stepSize": 0.2})
    model.save(str(tmp_path / "m"))
    loaded = boosting.BoostedModel.load(str(tmp_path / "m"))
    first, second = (m.predict(rows, FEATURES).select("probability").collect() for m in (model, loaded))
    assert first == second and loaded.featureImportances == model.featureImportances
    assert math.isclose(sum(model.featureImportances), 1.0)
    with pytest.raises(ValueError, match="was made with"):
        model.predict(rows, ["b", "a", "c"])


def test_odd_inputs(spark, rows):
    with pytest.raises(ValueError, match="no settings"):
        boosting.Setting.of({"numTrees": 3})
    with pytest.raises(ValueError, match="no rows"):
        boosting.bin_rows(rows.limit(0), FEATURES, "bad_score")
    with pytest.raises(Exception, match="lacks values"):
        models.train(rows.withColumn("b", F.when(F.col("a") > 1, F.col("b"))), "xgb", FEATURES, {"maxIter": 1})
    constant = models.train(rows.withColumn("a", F.lit(1.0)), "xgb", ["a"], {"maxIter": 2})
    assert all(f == -1 for t in constant.trees for f in t["feature"])
    assert constant.predict(rows.withColumn("a", F.lit(1.0)), ["a"]).select("probability").distinct().count() == 1
