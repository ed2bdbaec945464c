"""Recursive feature elimination with cross-validation."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderlens.operators import boosting, models
from orderlens.operators.sampling import SEED, stratified_folds
from orderlens.session import small_table


class Selector:
    """Keeps the feature count with the best mean F1.

    In each fold the least important feature (by the fold's own model) is dropped until one
    is left, scoring every size on the held-out part.  The same elimination on all rows
    then stops at the best size; ties go to fewer features.
    """

    def __init__(
        self, seed: int = SEED, n_folds: int = 5, params: dict | None = None, scale_weight: float | None = None
    ):
        self.seed = seed
        self.n_folds = n_folds
        self.params = params
        self.scale_weight = scale_weight
        self.features_to_keep_: list[str] | None = None
        self.support_: dict[str, bool] | None = None
        self.cv_results: DataFrame | None = None
        self.passes: int | None = None

    def fit(self, df: DataFrame, features: list[str] | None = None) -> "Selector":
        """One step drops a feature in every fold and on all rows; its models are made in the same passes
        over one table of bin numbers."""
        features = features or models.feature_label_split(df)[0]
        weight = self.scale_weight or models.positive_weight(models.class_weights(df, "gbt"))
        keys = [c for c in ("order_id", models.LABEL) if c in df.columns]
        folded = stratified_folds(df.select(*keys, *features), self.n_folds, self.seed)
        rows = boosting.bin_rows(folded, features, models.LABEL, "fold")
        setting = boosting.Setting.of(self.params)
        parts = [*range(self.n_folds), None]  # the last: all rows
        kept = {part: list(range(len(features))) for part in parts}
        sizes: dict[int, list[str]] = {}
        scores, self.passes = [], 0
        try:
            for size in range(len(features), 0, -1):
                fits = {p: boosting.Fit(setting, tuple(kept[p]), weight, p, self.seed) for p in parts}
                self.passes += boosting.fit_together(rows, list(fits.values()), df.sparkSession)
                sizes[size] = [features[i] for i in kept[None]]
                scores += [(size, fold, fits[fold].f1()) for fold in range(self.n_folds)]
                for part, fit in fits.items():
                    kept[part] = _without_least(kept[part], boosting.BoostedModel.of(rows, fit))
        finally:
            rows.release()
        by_size = {n: sum(f1 for size, _, f1 in scores if size == n) / self.n_folds for n in sizes}
        best_size = max(by_size, key=lambda n: (by_size[n], -n))
        self.features_to_keep_ = sizes[best_size]
        self.support_ = {f: f in self.features_to_keep_ for f in features}
        self.cv_results = small_table(
            df.sparkSession,
            [(n, fold, f1, by_size[n]) for n, fold, f1 in scores],
            "n_features int, fold int, f1 double, mean_f1 double",
        )
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.features_to_keep_ is None:
            raise models.NotFittedError("fit the selector first")
        return apply_selection(df, self.features_to_keep_)


def _without_least(kept: list[int], model: boosting.BoostedModel) -> list[int]:
    importances = model.featureImportances.toArray()
    least = min(kept, key=lambda i: (importances[i], i))
    return [i for i in kept if i != least]


def apply_selection(df: DataFrame, features: list[str]) -> DataFrame:
    """The kept features with whatever id and label columns the rows carry."""
    carried = [c for c in df.columns if c in models.NOT_FEATURES]
    return df.select(*carried, *features)
