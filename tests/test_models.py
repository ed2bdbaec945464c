import json
import math
import random

import pytest
from pyspark.sql import functions as F

from orderlens import queries
from orderlens.functions.expressions import hundredths
from orderlens.operators import evaluate, impact, models, sampling, scoring, selection, transform
from orderlens.operators.transform import NotFittedError


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    data = []
    for i in range(400):
        late, items = rng.randint(-20, 10), rng.randint(1, 4)
        bad = int(rng.random() < (0.8 if late > 0 else 0.5 if items > 2 else 0.1))
        data.append((f"o{i}", bad, float(late), float(items), rng.random()))
    return spark.createDataFrame(data, "order_id string, bad_score int, late double, items double, noise double").cache()


def test_split_is_complete_exact_and_partition_free(spark, rows):
    split = sampling.stratified_split(rows)
    assert split.count() == 400
    counts = {(r["bad_score"], r["split"]): r["count"] for r in split.groupBy("bad_score", "split").count().collect()}
    for label in (0, 1):
        n = counts[label, "train"] + counts[label, "test"]
        assert counts[label, "train"] == math.floor(n * 0.8)
    again = sampling.stratified_split(rows.repartition(17))
    assert split.exceptAll(again).count() == 0
    assert split.exceptAll(sampling.stratified_split(rows, seed=5)).count() > 0


def test_split_equals_a_plain_window(spark, rows):
    expected = rows.selectExpr(
        "order_id",
        "row_number() over (partition by bad_score order by md5(concat('123|', order_id)), order_id) r",
        "count(*) over (partition by bad_score) n",
    ).where("r <= floor(n * 0.8)")
    train = sampling.stratified_split(rows).where("split = 'train'").select("order_id")
    assert train.exceptAll(expected.select("order_id")).count() == 0 and train.count() == expected.count()


def test_folds_are_even(spark, rows):
    counts = sampling.stratified_folds(rows).groupBy("bad_score", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in counts if r["bad_score"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_ranks_do_not_depend_on_the_number_of_buckets(spark, rows, monkeypatch):
    """Five digits when a bucket may hold next to nothing; no task then meets more than a few rows."""
    from orderlens.functions import ranks

    folds, split = sampling.stratified_folds(rows), sampling.stratified_split(rows)
    assert ranks.digits_for(400) == 3 and ranks.digits_for(10**12) == 6
    monkeypatch.setattr(ranks, "ROWS_OF_A_BUCKET", 0.001)
    assert ranks.digits_for(400) == 5
    assert folds.exceptAll(sampling.stratified_folds(rows)).count() == 0
    assert split.exceptAll(sampling.stratified_split(rows)).count() == 0
    hashed = ranks._hashed(rows, "order_id", 1, 5)
    assert hashed.groupBy(ranks.BUCKET).count().agg(F.max("count")).first()[0] <= 3


def test_folds_do_not_depend_on_partitions(spark, rows):
    a, b = sampling.stratified_folds(rows), sampling.stratified_folds(rows.repartition(11))
    assert a.exceptAll(b).count() == 0 and a.count() == 400


def test_encoding_stays_between_means_and_prior(spark):
    data = [(f"c{i % 7}", int(i * i % 5 < i % 7)) for i in range(300)]
    df = spark.createDataFrame(data, "category string, bad_score int")
    means = [r[1] for r in df.groupBy("category").agg(F.avg("bad_score")).collect()]
    for r in transform.target_encoding(df).collect():
        assert min(means) <= r["encoded"] <= max(means) and min(means) <= r["prior"] <= max(means)


def test_sample_is_exact_and_seeded(spark, rows):
    a, b = sampling.validation_sample(rows), sampling.validation_sample(rows.repartition(3))
    assert a.count() == 80 and a.exceptAll(b).count() == 0


def test_target_encoding(spark):
    data = [("a", i % 2) for i in range(20)] + [("b", int(i < 10)) for i in range(80)]
    df = spark.createDataFrame(data, "category string, bad_score int")
    got = {r["category"]: r for r in transform.target_encoding(df).collect()}
    assert got["a"]["prior"] == pytest.approx(0.2) and got["a"]["encoded"] == pytest.approx(0.35)
    fitted = transform.apply_encoding(spark.createDataFrame([("a",), ("new",), (None,)], "category string"), transform.target_encoding(df), 0.2)
    values = sorted(r[0] for r in fitted.collect())
    assert values == [pytest.approx(0.2), pytest.approx(0.2), pytest.approx(0.35)]


def test_transformer_round_trip_and_large_category_table(spark, tmp_path):
    data = [(f"o{i}", f"c{i % 9}", i % 2, i % 30, i % 11 - 5, i % 7, i % 5, 10.0 + i, 1.0) for i in range(200)]
    df = spark.createDataFrame(
        data,
        "order_id string, category string, bad_score int, delivery_days int, estimated_delivery_diff int, "
        "processing_days int, seller_disp_diff int, total_price double, total_freight double",
    )
    fitted = transform.OrderTransformer().fit(df)
    expected = sorted(map(str, fitted.transform(df).collect()))
    fitted.write().overwrite().save(str(tmp_path / "t"))
    loaded = transform.OrderTransformerModel.load(str(tmp_path / "t"))
    assert sorted(map(str, loaded.transform(df).collect())) == expected
    assert loaded.bounds == fitted.bounds
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the table were too large to broadcast
    try:
        assert sorted(map(str, transform.OrderTransformer().fit(df).transform(df).collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    with pytest.raises(NotFittedError):
        transform.OrderTransformerModel().transform(df)


def test_transformer_is_a_pipeline_stage(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    data = [(f"c{i % 4}", i % 2, i % 30 + 9 * (i % 2), i % 11 - 5, i % 7, i % 5, 10.0 + i, 1.0) for i in range(120)]
    df = spark.createDataFrame(
        data,
        "category string, bad_score int, delivery_days int, estimated_delivery_diff int, processing_days int, "
        "seller_disp_diff int, total_price double, total_freight double",
    )
    stages = [
        transform.OrderTransformer(smoothing=5.0),
        VectorAssembler(inputCols=["delivery_days", "category", "log_total_price"], outputCol="features"),
        RandomForestClassifier(numTrees=3, labelCol="bad_score", seed=1),
    ]
    fitted = Pipeline(stages=stages).fit(df)
    fitted.write().overwrite().save(str(tmp_path / "p"))
    loaded = PipelineModel.load(str(tmp_path / "p"))
    assert loaded.stages[0].getOrDefault("smoothing") == 5.0
    first, second = (sorted(map(str, m.transform(df).select("probability").collect())) for m in (fitted, loaded))
    assert first == second


def test_sample_size_is_rounded(spark):
    for n, expected in ((10, 2), (12, 2), (13, 3), (1, 0), (3, 1)):
        ids = spark.range(n).withColumnRenamed("id", "order_id")
        assert sampling.validation_sample(ids).count() == expected


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 79 + [(1,)] * 21, "bad_score int")
    assert evaluate.class_weight(df).first()["pos_weight"] == pytest.approx(79 / 21)
    assert {r["bad_score"]: r["weight"] for r in evaluate.balanced_weights(df).collect()} == {
        0: pytest.approx(100 / 158), 1: pytest.approx(100 / 42),
    }
    assert models.class_weights(df, "rf") == {0: pytest.approx(100 / 158), 1: pytest.approx(100 / 42)}


def test_published_confusion_cells(spark):
    cells = {(1, 1): 1983, (0, 1): 2757, (0, 0): 12371, (1, 0): 2051}
    parts = [spark.range(n).select(F.lit(y).alias("bad_score"), F.lit(p).alias("prediction")) for (y, p), n in cells.items()]
    df = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    report = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert round(report["1"]["precision"], 3) == 0.418 and round(report["1"]["recall"], 3) == 0.492
    assert round(report["1"]["f1"], 3) == 0.452 and round(report["accuracy"]["f1"], 3) == 0.749
    assert [tuple(r) for r in evaluate.confusion_matrix(df).collect()] == [(0, 12371, 2757), (1, 2051, 1983)]
    assert evaluate.f1(df.where("bad_score = 0")).first()[0] == 0.0




def test_hundredths_agree_with_every_threshold(spark):
    df = spark.range(101).select(F.col("id").cast("int").alias("t")).withColumn("p", F.col("t") / F.lit(100.0))
    near = df.select("t", hundredths(F.col("p")).alias("got"), hundredths(F.col("p") - 1e-12).alias("below"))
    for r in near.collect():
        assert r["got"] == r["t"] and r["below"] == r["t"] - 1


def test_sweep_matches_direct_counts_and_is_monotone(spark):
    rng = random.Random(2)
    data = [(int(rng.random() < 0.3), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(data, "bad_score int, probability double")
    rows = evaluate.threshold_sweep(df).orderBy("threshold").collect()
    assert [r["threshold"] for r in rows] == list(range(10, 91))
    for r in rows:
        assert r["tp"] == sum(y == 1 and p >= r["threshold"] / 100 for y, p in data)
        assert r["tn"] == sum(y == 0 and p < r["threshold"] / 100 for y, p in data)
    assert all(a["recall"] >= b["recall"] for a, b in zip(rows, rows[1:]))


def test_model_types_and_search_space():
    assert [models.model_choice(n) for n in ("XGB", "gbt", "RF")] == ["gbt", "gbt", "rf"]
    with pytest.raises(ValueError):
        models.model_choice("svm")
    drawn = models.search_space("xgb", 50, seed=4)
    assert drawn == models.search_space("xgb", 50, seed=4) != models.search_space("xgb", 50, seed=5)
    for p in drawn:
        assert 3 <= p["maxDepth"] <= 7 and 200 <= p["maxIter"] <= 800 and 0.01 <= p["stepSize"] <= 0.1
        assert 0.6 <= float(p["featureSubsetStrategy"]) <= 1.0
    assert all(100 <= p["numTrees"] <= 500 for p in models.search_space("rf", 20))


SPACE = {"numTrees": ("int", 3, 5), "maxDepth": ("int", 2, 4)}


def test_tune_save_load_refit(spark, rows, tmp_path):
    model = models.RiskModel("rf", n_trials=2)
    for unfitted in (model.predict, model.predict_proba, model.fit):
        with pytest.raises(NotFittedError):
            unfitted(rows)
    with pytest.raises(NotFittedError):
        model.save(str(tmp_path / "m"))
    model.tune_and_fit(rows, n_folds=2, space=SPACE)
    trials = model.trials_.collect()
    assert len(trials) == 4 and 0 < model.best_score_ <= 1
    by_trial = {t: sum(r["f1"] for r in trials if r["trial"] == t) / 2 for t in (0, 1)}
    assert model.best_score_ == pytest.approx(max(by_trial.values()))
    model.save(str(tmp_path / "m.pkl"))
    loaded = models.RiskModel.load(str(tmp_path / "m"))
    before, after = (sorted(map(str, m.predict_proba(rows).collect())) for m in (model, loaded))
    assert before == after and loaded.best_params_ == model.best_params_
    loaded.fit(rows)
    assert loaded.predict(rows).select("prediction").distinct().count() == 2
    with pytest.raises(ValueError, match="could not find"):
        models.RiskModel.load(str(tmp_path / "absent"))


def test_selection_and_impact_find_the_driver(spark, rows):
    params = {"maxIter": 3, "maxDepth": 2}
    selector = selection.Selector(n_folds=2, params=params).fit(rows)
    assert "late" in selector.features_to_keep_
    assert selector.cv_results.count() == 6
    assert selector.transform(rows).columns == ["order_id", "bad_score", *selector.features_to_keep_]
    with pytest.raises(NotFittedError):
        selection.Selector().transform(rows)
    features = ["late", "items", "noise"]
    model = models.train(rows, "xgb", features, params)
    drops = {r["feature"]: r["f1_drop"] for r in impact.permutation_importance(rows, model, features).collect()}
    assert max(drops, key=drops.get) == "late" and len(drops) == 3
    deciles = impact.impact_by_decile(rows, model, features).where("feature = 'late'").orderBy("decile").collect()
    assert sum(r["n"] for r in deciles) == 400
    assert deciles[-1]["mean_probability"] > deciles[0]["mean_probability"]
    order = [r["importance"] for r in models.feature_importances(model, features, spark).collect()]
    assert order == sorted(order)


def test_forest_scores_in_a_session_that_observes(spark, rows):
    from pyspark.sql import Observation

    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    model = models.train(rows, "rf", ["late", "items"], {"numTrees": 3, "maxDepth": 3})
    assert not model.hasSummary and seen.get["n"] == 400
    assert models.predict(rows, model, ["late", "items"]).count() == 400
    assert models.evaluate.f1(models.predict(rows, model, ["late", "items"])).first()[0] > 0


def test_per_fold_preparation(spark, rows):
    class Shift:
        def fit(self, df):
            self.mean = df.agg(F.avg("late")).first()[0]
            return self

        def transform(self, df):
            return df.withColumn("late", F.col("late") - self.mean)

    found = models.tune(rows, "rf", ["late", "items"], 1, 2, space=SPACE, parallelism=1, prepare=models.per_fold(Shift()))
    assert 0 < found["best_score"] <= 1


def test_scoring_rules_and_decision(spark):
    df = spark.createDataFrame(
        [("a", 2, 10, "toys", 1.5, 5, 0, 20.0, 0.50), ("b", 1, -1, "nope", 0.01, 60, 3, -1.0, 0.49), ("c", 1, None, "art", 1.0, 1, 31, 0.0, 0.9)],
        "order_id string, num_items int, desc_len int, category string, weight_kg double, delivery_days int, "
        "estimated_delivery_diff int, freight_value double, probability double",
    )
    bad = {r["rule"].split()[0]: r["n_bad"] for r in scoring.input_rules(df).collect()}
    assert bad == {"num_items": 0, "desc_len": 2, "weight_kg": 1, "delivery_days": 1, "estimated_delivery_diff": 1, "freight_value": 1, "category": 1}
    features = {r["order_id"]: r for r in scoring.scoring_features(df).collect()}
    assert features["a"]["weight_g"] == 1500 and features["a"]["log_total_freight"] == pytest.approx(math.log(21))
    assert list(features["a"].asDict())[1:] == scoring.SCORING_COLUMNS
    decided = {r["order_id"]: (r["risk_percent"], r["risk_level"]) for r in scoring.risk_decision(df, 0.5).collect()}
    assert decided["a"] == ("50.0%", "High Risk") and decided["b"] == ("49.0%", "Safe")
    reasons = {r["order_id"]: r["risk_factors"] for r in scoring.risk_factors(df).collect()}
    assert reasons["a"] == ["multiple items"] and reasons["b"] == ["delayed by 3 day(s)"]
    with pytest.raises(ValueError):
        scoring.risk_decision(df, 0.95)
    assert len(scoring.CATEGORIES) == 72


def test_no_probability_is_no_decision_and_ties_go_to_the_even_tenth(spark):
    rows = [(0, None), (1, 0.4325), (0, 0.1225), (1, 0.0625), (0, 0.5)]
    df = spark.createDataFrame(rows, "bad_score int, probability double")
    got = scoring.risk_decision(df).select("risk_percent", "risk_level").collect()
    assert [tuple(r) for r in got] == [
        (None, None), ("43.2%", "Safe"), ("12.2%", "Safe"), ("6.2%", "Safe"), ("50.0%", "High Risk"),
    ]
    assert evaluate.threshold_sweep(df).where("threshold = 90").first()["fp"] == 0


def whole_search(spark, monkeypatch, name):
    """Trials of a registered search over made-up rows with fewer rounds."""
    chance = random.Random(2)
    columns = queries.scoring.SCORING_COLUMNS
    rows = [(f"o{i}", int(chance.random() < 0.4), *(chance.random() for _ in columns)) for i in range(120)]
    schema = "order_id string, bad_score int, " + ", ".join(f"{c} double" for c in columns)
    train = spark.createDataFrame(rows, schema)
    monkeypatch.setattr(queries, "_prepared", lambda spark, folder: (None, train, train))
    monkeypatch.setitem(queries.SPACE, "gbt", queries.SPACE["gbt"] | {"maxIter": ("int", 1, 2), "maxDepth": ("int", 1, 2)})
    return queries.QUERIES[name](spark, "").collect()


def settings_of(trials):
    """Drawn settings by trial, without the number of rounds."""
    drawn = {r["trial"]: json.loads(r["params"]) for r in trials}
    return [tuple(v for k, v in sorted(p.items()) if k != models.ROUNDS) for p in drawn.values()]


def test_search_space_draws_every_trial_in_full(spark, monkeypatch):
    trials = whole_search(spark, monkeypatch, "search_space")
    assert len(trials) == 10 and all(0 <= r["mean_f1"] <= 1 for r in trials)
    assert len(set(settings_of(trials))) == 10


def test_tune_makes_fits_of_its_own_for_every_trial(spark, monkeypatch):
    made = []
    together = models.boosting.fit_together
    monkeypatch.setattr(models.boosting, "fit_together", lambda rows, fits, s: made.extend(fits) or together(rows, fits, s))
    trials = whole_search(spark, monkeypatch, "tune")
    assert len({(r["trial"], r["fold"]) for r in trials}) == 100
    assert len(set(settings_of(trials))) == 20 and len(made) == 100
