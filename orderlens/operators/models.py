"""Tree classifiers: construction, weights, cross-validation, search, refit, prediction."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import boosting, evaluate
from orderlens.operators.sampling import SEED, stratified_folds
from orderlens.operators.transform import NotFittedError
from orderlens.session import ensure_checkpoint_dir, materialize, small_table

LABEL, WEIGHT, FEATURES = "bad_score", "_weight", "_features"
NOT_FEATURES = ("order_id", "review_score", "bad_score", "split", "fold")
ALIASES = {"xgb": "gbt", "gbt": "gbt", "xgboost": "gbt", "rf": "rf", "random forest": "rf"}
MODEL_CLASSES = {"gbt": boosting.BoostedModel, "rf": RandomForestClassificationModel}


def model_choice(model_type: str) -> str:
    """Normalised model type: gradient-boosted trees or a forest, by short or by offered name."""
    chosen = ALIASES.get(str(model_type).lower())
    if chosen is None:
        raise ValueError(f"unknown model type {model_type!r}: use 'xgb' (or 'gbt') or 'rf'")
    return chosen


def feature_label_split(df: DataFrame) -> tuple[list[str], str]:
    """Feature columns in table order, and the label column."""
    return [c for c in df.columns if c not in NOT_FEATURES], LABEL


def with_weights(df: DataFrame, model_type: str, weights: dict[int, float] | None = None) -> DataFrame:
    """Row weights: negatives / positives for positives (boosted), balanced (forest)."""
    weights = weights or class_weights(df, model_type)
    return df.withColumn(WEIGHT, F.when(F.col(LABEL) == 1, weights[1]).otherwise(weights[0]))


def class_weights(df: DataFrame, model_type: str) -> dict[int, float]:
    counts = evaluate.class_weight(df).first()
    n0, n1 = counts["n_negative"], counts["n_positive"]
    if not n0 or not n1:
        raise ValueError("training rows need both classes")
    if model_choice(model_type) == "gbt":
        return {0: 1.0, 1: n0 / n1}
    return {0: (n0 + n1) / (2 * n0), 1: (n0 + n1) / (2 * n1)}


def make_forest(params: dict | None = None, seed: int = SEED) -> RandomForestClassifier:
    """An unfitted forest.  Without parameters: the settings used for inspection."""
    columns = {"featuresCol": FEATURES, "labelCol": LABEL, "weightCol": WEIGHT, "seed": seed}
    return RandomForestClassifier(**columns, **{"numTrees": 100, "maxDepth": 5, **(params or {})})


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=FEATURES, handleInvalid="error").transform(df)


def train(
    df: DataFrame,
    model_type: str,
    features: list[str] | None = None,
    params: dict | None = None,
    seed: int = SEED,
    weights: dict[int, float] | None = None,
):
    """Fit one weighted classifier on the rows.

    The copy of a forest leaves the training summary behind, which would keep the training rows
    alive and travel with every scoring task.
    """
    features = features or feature_label_split(df)[0]
    if model_choice(model_type) == "gbt":
        setting = boosting.Setting.of(params)
        rows = boosting.bin_rows(df, features, LABEL)
        fit = boosting.Fit(setting, tuple(range(len(features))), positive_weight(weights or class_weights(df, "gbt")), seed=seed)
        try:
            boosting.fit_together(rows, [fit], df.sparkSession)
        finally:
            rows.release()
        return boosting.BoostedModel.of(rows, fit)
    ensure_checkpoint_dir(df.sparkSession)
    rows = assemble(with_weights(df, model_type, weights), features)
    return make_forest(params, seed).fit(rows.select(LABEL, WEIGHT, FEATURES)).copy()


def positive_weight(weights: dict[int, float]) -> float:
    return weights[1] / weights[0]


def predict(df: DataFrame, model, features: list[str]) -> DataFrame:
    """Add ``prediction`` (0/1 at 0.5) and ``probability`` (of the positive class)."""
    if isinstance(model, boosting.BoostedModel):
        return model.predict(df, features)
    scored = model.transform(assemble(df, features))
    return scored.select(
        *df.columns,
        F.col(model.getPredictionCol()).cast("int").alias("prediction"),
        vector_to_array(F.col(model.getProbabilityCol()))[1].alias("probability"),
    )


def feature_importances(model, features: list[str], spark: SparkSession) -> DataFrame:
    """(feature, importance), least important first; one row per feature."""
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return small_table(spark, rows, "feature string, importance double").orderBy("importance", "feature")


# ---------------------------------------------------------------------------
# cross-validation and search

# Ranges of the search.
SEARCH_SPACE = {
    "gbt": {
        "maxDepth": ("int", 3, 7),
        "stepSize": ("log", 0.01, 0.1),
        "maxIter": ("int", 200, 800),
        "subsamplingRate": ("float", 0.7, 1.0),
        "featureSubsetStrategy": ("share", 0.6, 1.0),
        "minChildWeight": ("int", 2, 15),
        "gamma": ("float", 0.0, 5.0),
    },
    "rf": {
        "maxDepth": ("int", 5, 15),
        "numTrees": ("int", 100, 500),
        "minInstancesPerNode": ("int", 1, 15),
        "featureSubsetStrategy": ("share", 0.4, 0.8),
    },
}


ROUNDS = "maxIter"
ROUNDS_PER_FIT = 5


def search_space(
    model_type: str, n_trials: int, seed: int = SEED, space: dict | None = None, rounds_per_fit: int = ROUNDS_PER_FIT
) -> list[dict]:
    """Seeded parameter sets drawn from the ranges; the same seed gives the same list.

    Boosted trees: ``rounds_per_fit`` trials in a row differ in the number of rounds only, as the
    first trees of a fit are the fit with fewer rounds; with 1 every trial draws all its values.
    """
    ranges = space or SEARCH_SPACE[model_choice(model_type)]
    rng = random.Random(seed)

    def draw(kind, low, high):
        if kind == "int":
            return rng.randint(low, high)
        if kind == "log":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        value = rng.uniform(low, high)
        return f"{value:.4f}" if kind == "share" else value

    trials: list[dict] = []
    for i in range(n_trials):
        drawn = {name: draw(*how) for name, how in ranges.items()}
        if ROUNDS in ranges and i % rounds_per_fit:
            drawn = {**trials[-1], ROUNDS: drawn[ROUNDS]}
        trials.append(drawn)
    return trials


def fold_f1(
    rows: DataFrame,
    fold: int,
    model_type: str,
    features: list[str],
    params: dict,
    seed: int,
    weights: dict[int, float],
    prepare: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]] | None = None,
):
    """Fit on the other folds and score one: (F1, fitted model)."""
    fit_rows, held_out = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
    if prepare:
        fit_rows, held_out = prepare(fit_rows, held_out)
    model = train(fit_rows, model_type, features, params, seed, weights)
    return evaluate.f1(predict(held_out, model, features)).first()["f1"], model


def per_fold(transformer) -> Callable:
    """Preparation that fits ``transformer`` on the training part of each fold only."""

    def prepare(fit_rows: DataFrame, held_out: DataFrame):
        fitted = transformer.fit(fit_rows)
        return fitted.transform(fit_rows), fitted.transform(held_out)

    return prepare


def tune(
    df: DataFrame,
    model_type: str,
    features: list[str] | None = None,
    n_trials: int | None = None,
    n_folds: int = 5,
    seed: int = SEED,
    space: dict | None = None,
    parallelism: int = 2,
    prepare: Callable | None = None,
    rounds_per_fit: int = ROUNDS_PER_FIT,
) -> dict:
    """Search for the best mean F1 over stratified folds.

    ``rounds_per_fit`` is that of :func:`search_space`; with 1 every trial has values of its own.

    Returns best_params, best_score, trials (trial, params, fold, f1) and, for boosted trees, the
    number of passes over the rows.  Boosted trees of all trials and folds are made together
    (:mod:`orderlens.operators.boosting`).  Forests are fitted one by one; their folded rows are kept in
    executor memory and disk because every trial and fold reads them.
    """
    chosen = model_choice(model_type)
    n_trials = n_trials or {"gbt": 100, "rf": 50}[chosen]
    features = features or feature_label_split(df)[0]
    weights = class_weights(df, model_type)
    candidates = search_space(model_type, n_trials, seed, space, rounds_per_fit)
    jobs = [(trial, fold) for trial in range(n_trials) for fold in range(n_folds)]
    passes = None
    if chosen == "gbt":
        folded = materialize(stratified_folds(df, n_folds, seed), "folds")
        found, passes = _boosted_scores(folded, candidates, features, n_folds, seed, positive_weight(weights), prepare)
        scores = [found[job] for job in jobs]
    else:
        rows = stratified_folds(df, n_folds, seed).persist(StorageLevel.MEMORY_AND_DISK)

        def run(job):
            trial, fold = job
            return fold_f1(rows, fold, model_type, features, candidates[trial], seed, weights, prepare)[0]

        try:
            with ThreadPool(parallelism) as pool:
                scores = pool.map(run, jobs, chunksize=1)
        finally:
            rows.unpersist()
    means = [sum(scores[t * n_folds : (t + 1) * n_folds]) / n_folds for t in range(n_trials)]
    best = max(range(n_trials), key=lambda t: (means[t], -t))
    table = [(t, json.dumps(candidates[t], sort_keys=True), f, float(s)) for (t, f), s in zip(jobs, scores)]
    trials = small_table(df.sparkSession, table, "trial int, params string, fold int, f1 double")
    return {"best_params": candidates[best], "best_score": means[best], "trials": trials, "passes": passes}


def _boosted_scores(
    folded: DataFrame, candidates: list[dict], features: list[str], n_folds: int, seed: int, weight: float,
    prepare: Callable | None,
) -> tuple[dict[tuple[int, int], float], int]:
    """F1 by (trial, fold) and the passes made.  Trials that differ in rounds only share a fit.

    All folds are one table of bin numbers; with ``prepare`` each fold has its own.
    """
    groups: dict[str, list[int]] = {}
    for trial, params in enumerate(candidates):
        same = json.dumps({k: v for k, v in params.items() if k != ROUNDS}, sort_keys=True)
        groups.setdefault(same, []).append(trial)
    settings = {trial: boosting.Setting.of(params) for trial, params in enumerate(candidates)}
    columns = tuple(range(len(features)))
    scores, passes = {}, 0
    for part in [range(n_folds)] if prepare is None else [[fold] for fold in range(n_folds)]:
        rows = folded
        if prepare is not None:
            fold = part[0]
            fit_rows, held_out = prepare(folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold))
            rows = fit_rows.unionByName(held_out)
        binned = boosting.bin_rows(rows, features, LABEL, "fold")
        fits = {
            (trials[0], fold): boosting.Fit(
                max((settings[t] for t in trials), key=lambda s: s.rounds), columns, weight, fold, seed
            )
            for trials in groups.values()
            for fold in part
        }
        try:
            passes += boosting.fit_together(binned, list(fits.values()), folded.sparkSession)
        finally:
            binned.release()
        for trials in groups.values():
            for trial in trials:
                for fold in part:
                    scores[trial, fold] = fits[trials[0], fold].f1(settings[trial].rounds)
    return scores, passes


class RiskModel:
    """A tuned classifier: search, refit, predict, save and load."""

    def __init__(self, model_type: str, seed: int = SEED, n_trials: int = 100):
        self.model_type = model_choice(model_type)
        self.seed = seed
        self.n_trials = n_trials
        self.best_params_: dict | None = None
        self.best_score_: float | None = None
        self.best_model_ = None
        self.features_: list[str] | None = None
        self.trials_: DataFrame | None = None

    def _check_fitted(self) -> None:
        if self.best_model_ is None:
            raise NotFittedError("fit the model first")

    def tune_and_fit(self, df: DataFrame, features: list[str] | None = None, **search):
        """Search, then train the best parameters on all rows."""
        self.features_ = features or feature_label_split(df)[0]
        found = tune(df, self.model_type, self.features_, n_trials=self.n_trials, seed=self.seed, **search)
        self.best_params_, self.best_score_ = found["best_params"], found["best_score"]
        self.trials_ = found["trials"]
        self.best_model_ = train(df, self.model_type, self.features_, self.best_params_, self.seed)
        return self.best_model_

    def fit(self, df: DataFrame):
        """Train the tuned parameters again on other rows."""
        self._check_fitted()
        self.best_model_ = train(df, self.model_type, self.features_, self.best_params_, self.seed)
        return self.best_model_

    def predict(self, df: DataFrame) -> DataFrame:
        self._check_fitted()
        return predict(df, self.best_model_, self.features_).drop("probability")

    def predict_proba(self, df: DataFrame) -> DataFrame:
        self._check_fitted()
        return predict(df, self.best_model_, self.features_).drop("prediction")

    def save(self, path: str) -> None:
        """Write the model and its settings below ``path`` (a trailing .pkl is ignored)."""
        self._check_fitted()
        path = artifact_path(path)
        spark = SparkSession.active()
        if self.model_type == "gbt":
            self.best_model_.save(f"{path}/model")
        else:
            self.best_model_.write().overwrite().save(f"{path}/model")
        settings = json.dumps(
            {"type": self.model_type, "seed": self.seed, "params": self.best_params_,
             "score": self.best_score_, "features": self.features_}
        )
        small_table(spark, [(settings,)], "settings string").write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, path: str) -> "RiskModel":
        """Read a saved model; a missing one is a ValueError."""
        path = artifact_path(path)
        settings = json.loads(read_artifact(f"{path}/settings").first()["settings"])
        model = cls(settings["type"], settings["seed"])
        model.best_params_, model.best_score_ = settings["params"], settings["score"]
        model.features_ = settings["features"]
        model.best_model_ = MODEL_CLASSES[model.model_type].load(f"{path}/model")
        return model


def artifact_path(path: str) -> str:
    return path.rstrip("/").removesuffix(".pkl")


def read_artifact(path: str) -> DataFrame:
    try:
        return SparkSession.active().read.parquet(path)
    except AnalysisException as error:
        raise ValueError(f"could not find the saved artifact {path}") from error
