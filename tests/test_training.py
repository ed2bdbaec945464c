from conftest import SMALL
from orderlens.operators import cleaning, models, scoring, transform
from orderlens.plans import training
from orderlens.sources import star_schema
from pyspark.sql import functions as F

import pytest

SPACE = {
    "gbt": {"maxIter": ("int", 2, 3), "maxDepth": ("int", 2, 3)},
    "rf": {"numTrees": ("int", 3, 4), "maxDepth": ("int", 2, 3)},
}


def test_train_save_load_score(spark, tmp_path):
    tables = star_schema.relations(spark, SMALL)
    found = training.train_risk(
        tables, n_trials={"gbt": 1, "rf": 1}, n_folds=2, selector_params={"maxIter": 1, "maxDepth": 2}, space=SPACE
    )
    assert set(found.selector.features_to_keep_) <= set(found.selector.support_)
    support = {r["class"]: r["support"] for r in found.reports["rf"].collect()}
    assert support["accuracy"] == found.test.count() == support["0"] + support["1"]
    found.save(str(tmp_path / "assets"))
    assets = training.ScoringAssets.load(str(tmp_path / "assets"))
    rows = transform.log_transform(cleaning.cleaned_orders(tables))
    scored = assets.score(rows, "rf", clip=True).select("order_id", "probability")
    direct = found.models["rf"].predict_proba(found.transformer.transform(cleaning.cleaned_orders(tables)))
    different = scored.join(direct.select("order_id", F.col("probability").alias("p")), "order_id").where(
        F.abs(F.col("p") - F.col("probability")) > 1e-12
    )
    assert different.count() == 0 and scored.count() == direct.count()
    assert scoring.risk_decision(scored, 0.3).where("risk_level = 'High Risk' AND probability < 0.3").count() == 0
    with pytest.raises(ValueError, match="could not find"):
        training.ScoringAssets.load(str(tmp_path / "nothing"))
    with pytest.raises(ValueError):
        models.RiskModel("other")


def test_a_bundle_is_saved_whole(spark, tmp_path, monkeypatch):
    """A save that breaks off between the parts leaves the bundle before; a later one takes its place."""
    rng = [(f"o{i}", f"c{i % 4}", int(i % 5 == 0), i % 30, i % 11 - 5, i % 7, i % 5, 10.0 + i, 1.0 + i % 3) for i in range(200)]
    df = spark.createDataFrame(
        rng,
        "order_id string, category string, bad_score int, delivery_days int, estimated_delivery_diff int, "
        "processing_days int, seller_disp_diff int, total_price double, total_freight double",
    )
    folder, features = str(tmp_path / "bundle"), ["category", "delivery_days"]

    def pair(rounds):
        fitted = transform.OrderTransformer().fit(df)
        model = models.RiskModel("xgb")
        model.features_, model.best_params_ = features, {"maxIter": rounds, "maxDepth": 2}
        model.best_model_ = models.train(fitted.transform(df), "xgb", features, model.best_params_)
        return fitted, {"gbt": model}

    training.save_bundle(folder, *pair(1), threshold=0.3)
    monkeypatch.setattr(models.RiskModel, "save", lambda self, path: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        training.save_bundle(folder, *pair(2))
    monkeypatch.undo()
    old = training.ScoringAssets.load(folder)
    assert old.threshold == 0.3 and len(old.models["gbt"].best_model_.trees) == 1
    assert len([p for p in (tmp_path / "bundle").iterdir() if p.name.startswith("parts-")]) == 1
    training.save_bundle(folder, *pair(3))
    new = training.ScoringAssets.load(folder, ("XGB",))
    assert new.threshold == 0.5 and len(new.models["gbt"].best_model_.trees) == 3
    with pytest.raises(ValueError, match="no models"):
        training.ScoringAssets.load(folder, ("rf",))


def test_command_line_arguments(monkeypatch):
    from orderlens import __main__ as cli

    monkeypatch.setattr("sys.argv", ["orderlens", "score", "t", "m", "o", "--threshold", "0.4"])
    args = cli.arguments()
    assert (args.command, args.threshold, args.model) == ("score", 0.4, "gbt")
