"""From tables to a tuned, evaluated and saved model."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import cleaning, evaluate, models, sampling, scoring, selection, transform
from orderlens.schemas import Relations
from orderlens.session import delete_path, materialize
from orderlens.sources.versions import Versions


@dataclass
class TrainedRisk:
    """Everything a training run leaves behind."""

    transformer: transform.OrderTransformerModel
    selector: selection.Selector
    models: dict[str, models.RiskModel]
    test: DataFrame
    reports: dict[str, DataFrame]

    def save(self, folder: str, threshold: float = 0.5) -> None:
        save_bundle(folder, self.transformer, self.models, threshold)


def save_bundle(
    folder: str, transformer: transform.OrderTransformerModel, found: dict[str, models.RiskModel], threshold: float = 0.5
) -> None:
    """Write transformer, models, features and threshold as one version, which loading sees all of or none.

    The parts lie in a folder of their own; publishing its name is one rename.  A save that breaks
    off leaves the version before.
    """
    scoring.check_threshold(threshold)
    spark, folder = SparkSession.active(), folder.rstrip("/")
    versions = Versions(spark, folder)
    number, _ = versions.current()
    part = f"parts-{uuid.uuid4().hex}"
    try:
        transformer.write().overwrite().save(f"{folder}/{part}/transformer")
        for name, model in found.items():
            model.save(f"{folder}/{part}/{name}")
        features = {name: model.features_ for name, model in found.items()}
        versions.publish(number + 1, {"parts": part, "features": features, "threshold": threshold})
    except BaseException:
        delete_path(spark, f"{folder}/{part}")
        raise


@dataclass
class ScoringAssets:
    """A saved transformer and models, loaded once for any number of orders."""

    transformer: transform.OrderTransformerModel
    models: dict[str, models.RiskModel]
    threshold: float = 0.5

    @classmethod
    def load(cls, folder: str, names: tuple[str, ...] | None = None) -> "ScoringAssets":
        """The bundle published last, with the models of these types or all it has."""
        folder = folder.rstrip("/")
        _, state = Versions(SparkSession.active(), folder).current()
        if not state:
            raise ValueError(f"could not find the saved artifact {folder}")
        wanted = list(state["features"]) if names is None else [models.model_choice(n) for n in names]
        absent = [n for n in wanted if n not in state["features"]]
        if absent:
            raise ValueError(f"could not find the saved artifact {folder}: it has no models {absent}")
        path = f"{folder}/{state['parts']}"
        return cls(
            transform.OrderTransformerModel.load(f"{path}/transformer"),
            {t: models.RiskModel.load(f"{path}/{t}") for t in wanted},
            state["threshold"],
        )

    def score(self, df: DataFrame, model_type: str = "gbt", clip: bool = False) -> DataFrame:
        """Probability per row; category still as text, freight and price already as logs."""
        chosen = self.models[models.model_choice(model_type)]
        return scoring.score_orders(df, self.transformer, chosen.best_model_, chosen.features_, clip)


def prepared(tables: Relations, seed: int = sampling.SEED, test_size: float = 0.2):
    """Cleaned and split orders: (transformer, transformed train rows, transformed test rows).

    Cleaned orders are written once; fitting, splitting and searching read that table.
    """
    cleaned = materialize(cleaning.cleaned_orders(tables), "cleaned")
    split = materialize(sampling.stratified_split(cleaned, test_size, seed), "split")
    train, test = (split.where(F.col("split") == part).drop("split") for part in ("train", "test"))
    fitted = transform.OrderTransformer().fit(train)
    return fitted, fitted.transform(train), fitted.transform(test)


def train_risk(
    tables: Relations,
    model_types: tuple[str, ...] = ("gbt", "rf"),
    seed: int = sampling.SEED,
    n_trials: dict[str, int] | None = None,
    n_folds: int = 5,
    selector_params: dict | None = None,
    space: dict[str, dict] | None = None,
) -> TrainedRisk:
    """Split, transform, select features, tune each model and report on the held-out part."""
    fitted, train, test = prepared(tables, seed)
    train = materialize(train, "train")
    selector = selection.Selector(seed, n_folds, selector_params).fit(train)
    reduced_train, reduced_test = selector.transform(train), selector.transform(test)
    found, reports = {}, {}
    for name in model_types:
        trials = (n_trials or {"gbt": 100, "rf": 50})[models.model_choice(name)]
        model = models.RiskModel(name, seed, trials)
        model.tune_and_fit(
            reduced_train, selector.features_to_keep_, n_folds=n_folds, space=(space or {}).get(model.model_type)
        )
        found[model.model_type] = model
        reports[model.model_type] = evaluate.classification_report(model.predict(reduced_test))
    return TrainedRisk(fitted, selector, found, reduced_test, reports)
