"""Named queries over the driver's tables, one per operator.

Each takes (spark, folder), reads the tables whole and returns a DataFrame.  Decimals are
handed out as doubles so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import schemas
from orderlens.operators import (
    audit,
    cleaning,
    cleanup,
    evaluate,
    impact,
    models,
    profile,
    sampling,
    scoring,
    selection,
    transform,
)
from orderlens.plans import etl, training
from orderlens.plans import feature_view as fv
from orderlens.session import configure, materialize, scratch_path, small_table
from orderlens.sources import csv_files, star_schema
from orderlens.sources.tables import TableStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FOREST = {"numTrees": 100, "maxDepth": 5}
BOOSTED = {"maxIter": 12, "maxDepth": 4}
ELIMINATION = {"maxIter": 6, "maxDepth": 3}
# Ranges of the registered searches: fewer and shallower trees than the library's own ranges.
SPACE = {
    "gbt": models.SEARCH_SPACE["gbt"] | {"maxDepth": ("int", 3, 5), "stepSize": ("log", 0.1, 0.3), "maxIter": ("int", 5, 30)},
    "rf": {"maxDepth": ("int", 3, 5), "numTrees": ("int", 10, 20), "featureSubsetStrategy": ("share", 0.4, 0.8)},
}
TRIALS = {"gbt": 20, "rf": 3}
ROWS_OF_A_FILE = 500_000


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(configure(spark), folder)

        QUERIES[name] = run
        return run

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def _view(spark: SparkSession, folder: str) -> DataFrame:
    return fv.feature_view(star_schema.relations(spark, folder))


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.cleaned_orders(star_schema.relations(spark, folder))


def _reviewed(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.reviewed_orders(star_schema.relations(spark, folder))


def _raw(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A relation before cleanup, times as text."""
    df = getattr(star_schema, table)(spark, folder)
    return star_schema.raw_texts(df) if "order_id" in df.columns else df


def _export_csv(df: DataFrame, folder: str, table: str) -> None:
    """Write a relation the way the input files look, compressed.

    A compressed file is read by one task, so files are of a bounded number of rows.
    """
    name = csv_files.DATASETS[table].file_name.replace("*", "shop_")
    writer = df.write.option("header", True).option("quote", '"').option("escape", '"')
    writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", ROWS_OF_A_FILE)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{name}")


def with_rule_score(df: DataFrame) -> DataFrame:
    """A fixed arithmetic risk in hundredths, standing in for a model where results must be exact."""
    points = (
        F.lit(15)
        + F.when(F.col("is_delivery_late") == 1, 30).otherwise(0)
        + F.when(F.col("num_items") >= 5, 20).otherwise(0)
        + F.col("delivery_days")
    )
    probability = F.least(F.lit(100), points) / F.lit(100.0)
    return df.withColumn("probability", probability).withColumn(
        "prediction", F.when(F.col("probability") >= 0.5, 1).otherwise(0)
    )


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return with_rule_score(_cleaned(spark, folder))


def _split(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.stratified_split(_stored(_cleaned, spark, folder))


def _train_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder).where(F.col("split") == "train").drop("split")


def _stored(build: Query, spark: SparkSession, folder: str) -> DataFrame:
    """The result of a step as a stored table, for profiles that read it more than once."""
    return materialize(build(spark, folder), "stored")


# --- sources and sinks -----------------------------------------------------


@query("csv_scan")
def _(spark, folder):
    """Reviews written as CSV (texts with line breaks and quotes) and scanned back."""
    out = scratch_path(spark, "csv")
    _export_csv(_raw(spark, folder, "reviews"), out, "reviews")
    return csv_files.scan_dataset(spark, out, "reviews")


@query("dataset_registry")
def _(spark, folder):
    """Registered inputs in load order with the rows each holds."""
    tables = dict(star_schema.relations(spark, folder, texts=True).items())
    out = None
    for position, (table, dataset) in enumerate(csv_files.DATASETS.items(), start=1):
        row = tables[table].agg(
            F.lit(position).alias("position"),
            F.lit(table).alias("table_name"),
            F.lit(dataset.file_name).alias("file_name"),
            F.count("*").alias("n_rows"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("table_schemas")
def _(spark, folder):
    """Column types of the six tables with the values each column holds."""
    tables = dict(star_schema.relations(spark, folder, texts=True).items())
    out = None
    for table, spec in schemas.TABLES.items():
        counts = tables[table].agg(*[F.count(c).alias(c) for c in spec.columns])
        entries = [
            F.struct(F.lit(c).alias("column_name"), F.lit(t.simpleString()).alias("data_type"), F.col(c).alias("n_values"))
            for c, t in spec.columns.items()
        ]
        rows = counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*entries)))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("append_load")
def _(spark, folder):
    """Order items appended to an empty typed table and read back."""
    store = TableStore(spark, scratch_path(spark, "tables"))
    store.append(star_schema.order_items(spark, folder), "order_items", enforce=False)
    return plain(store.scan("order_items"))


@query("etl_status")
def _(spark, folder):
    """All six inputs through CSV, cleanup, rule checks and load; status per table.

    Item keys of the given tables repeat, so the run stops at order_items and says so.
    """
    source = scratch_path(spark, "csv")
    for table in csv_files.DATASETS:
        _export_csv(_raw(spark, folder, table), source, table)
    status = etl.run_etl(spark, source, TableStore(spark, scratch_path(spark, "tables")))
    return status.select("position", "table_name", "n_rows", "ok")


@query("etl_load")
def _(spark, folder):
    """The same run without rule checks, then the feature view over the loaded tables."""
    source = scratch_path(spark, "csv")
    for table in csv_files.DATASETS:
        _export_csv(_raw(spark, folder, table), source, table)
    store = TableStore(spark, scratch_path(spark, "tables"))
    etl.run_etl(spark, source, store, enforce=False)
    return plain(fv.feature_view(etl.stored_relations(store)))


@query("view_scan")
def _(spark, folder):
    fv.create_feature_view(star_schema.relations(spark, folder))
    return fv.view_scan(spark).agg(F.count("*").alias("n_rows"))


@query("create_feature_view")
def _(spark, folder):
    fv.create_feature_view(star_schema.relations(spark, folder))
    return plain(spark.sql(f"SELECT * FROM {fv.VIEW_NAME}"))


@query("save_load_artifacts")
def _(spark, folder):
    """Transformer and model saved and loaded as one bundle; the loaded pair transforms and scores the test rows.

    ``same_score`` tells whether a row's probability is that of the pair that was saved.
    """
    split = _split(spark, folder)
    train, test = (split.where(F.col("split") == part).drop("split") for part in ("train", "test"))
    fitted = transform.OrderTransformer().fit(train)
    rows = fitted.transform(train)
    model = models.RiskModel("xgb")
    model.features_, model.best_params_ = scoring.SCORING_COLUMNS, BOOSTED
    model.best_model_ = models.train(rows, "xgb", model.features_, BOOSTED)
    path = scratch_path(spark, "bundle")
    training.save_bundle(path, fitted, {"gbt": model})
    loaded = training.ScoringAssets.load(path)
    before = model.predict_proba(fitted.transform(test)).select("order_id", F.col("probability").alias("before"))
    scored = loaded.models["gbt"].predict_proba(loaded.transformer.transform(test)).join(before, "order_id")
    scored = scored.withColumn("same_score", F.col("probability") == F.col("before"))
    return _transformed_output(scored.drop("probability", "before"))


@query("constraint_audit")
def _(spark, folder):
    return audit.constraint_audit(dict(star_schema.relations(spark, folder).items()))


# --- cleanup ---------------------------------------------------------------


def _cleanup(name: str, table: str) -> None:
    step = getattr(cleanup, name)
    query(name)(lambda spark, folder: plain(step(_raw(spark, folder, table))))


for _table in schemas.TABLES:
    _cleanup(f"clean_{_table}", _table)


# --- feature view ----------------------------------------------------------


@query("feature_view")
def _(spark, folder):
    return plain(_view(spark, folder))


@query("filter_delivered")
def _(spark, folder):
    return fv.delivered_orders(star_schema.orders(spark, folder))


def _features(name: str, *columns: str) -> None:
    query(name)(lambda spark, folder: plain(_view(spark, folder).select("order_id", "review_id", *columns)))


_features("project_scores", "review_score")
_features("project_totals", "num_items", "total_price", "total_freight")
for _feature in ["bad_score", *schemas.FEATURE_COLUMNS[5:]]:
    _features(_feature, _feature)


@query("join_items")
def _(spark, folder):
    tables = star_schema.relations(spark, folder)
    joined = fv.join_items(fv.delivered_orders(tables.orders), fv.order_items_agg(tables.order_items))
    return plain(joined.select("order_id", "customer_id", "num_items", "total_price", "limit_date"))


@query("join_products")
def _(spark, folder):
    tables = star_schema.relations(spark, folder)
    joined = fv.join_products(fv.order_items_agg(tables.order_items), tables.products)
    return joined.select("order_id", "product_id", "product_category_name", "product_weight_g")


@query("join_reviews")
def _(spark, folder):
    tables = star_schema.relations(spark, folder)
    joined = fv.join_reviews(fv.delivered_orders(tables.orders).select("order_id", "customer_id"), tables.reviews)
    return joined.select("order_id", "customer_id", "review_id", "review_score")


@query("join_category")
def _(spark, folder):
    tables = star_schema.relations(spark, folder)
    joined = fv.join_category(tables.products, tables.category_names)
    return joined.select("product_id", "product_category_name", "product_category_name_english")


@query("order_items_agg")
def _(spark, folder):
    return plain(fv.order_items_agg(star_schema.order_items(spark, folder)).drop("most_imp_product_id"))


@query("most_important_product")
def _(spark, folder):
    return fv.order_items_agg(star_schema.order_items(spark, folder)).select("order_id", "most_imp_product_id")


# --- profiles --------------------------------------------------------------


@query("split_shipment_rate")
def _(spark, folder):
    return rounded(profile.split_shipment_rate(_cleaned(spark, folder)), "bad_rate")


@query("feature_view_grain")
def _(spark, folder):
    return profile.feature_view_grain(_view(spark, folder))


@query("review_score_ratios")
def _(spark, folder):
    return profile.review_score_ratios(_reviewed(spark, folder))


@query("bad_score_share")
def _(spark, folder):
    return profile.bad_score_share(_reviewed(spark, folder))


@query("top_categories")
def _(spark, folder):
    return profile.top_categories(_reviewed(spark, folder))


@query("null_counts")
def _(spark, folder):
    return profile.null_counts(_view(spark, folder), ["order_id", *schemas.FEATURE_COLUMNS])


@query("duplicate_count")
def _(spark, folder):
    return profile.duplicate_count(_view(spark, folder))


@query("shape_and_types")
def _(spark, folder):
    return profile.shape_and_types(_view(spark, folder))


@query("describe_numeric")
def _(spark, folder):
    return rounded(profile.describe_numeric(_stored(_view, spark, folder)), "mean", "std", "p25", "p50", "p75", places=4)


@query("clip_quantiles")
def _(spark, folder):
    return rounded(transform.clip_quantiles(_train_rows(spark, folder)), "value")


@query("tail_score_mix")
def _(spark, folder):
    return rounded(profile.tail_score_mix(_stored(_cleaned, spark, folder)), "ratio")


@query("correlation_matrix")
def _(spark, folder):
    cleaned = _stored(_cleaned, spark, folder)
    clipped = transform.clip_outliers(transform.add_log_columns(cleaned), transform.clip_bounds(cleaned))
    return rounded(profile.correlation_matrix(clipped), "correlation")


@query("histogram")
def _(spark, folder):
    found = profile.histogram(transform.add_log_columns(_stored(_reviewed, spark, folder)))
    return rounded(found, "lower_edge", "upper_edge")


@query("box_stats")
def _(spark, folder):
    return profile.box_stats(_reviewed(spark, folder))


# --- metrics ---------------------------------------------------------------


@query("class_weight")
def _(spark, folder):
    return rounded(evaluate.class_weight(_train_rows(spark, folder)), "pos_weight")


@query("balanced_weights")
def _(spark, folder):
    return rounded(evaluate.balanced_weights(_train_rows(spark, folder)), "weight")


@query("confusion_matrix")
def _(spark, folder):
    return evaluate.confusion_matrix(_scored(spark, folder))


@query("classification_report")
def _(spark, folder):
    return rounded(evaluate.classification_report(_scored(spark, folder)), "precision", "recall", "f1")


@query("f1")
def _(spark, folder):
    return rounded(evaluate.f1(_scored(spark, folder)), "f1")


@query("threshold_sweep")
def _(spark, folder):
    return rounded(evaluate.threshold_sweep(_scored(spark, folder)), "precision", "recall", "f1")


# --- cleaning, sampling, transformation ------------------------------------


@query("dedup_keep_last")
def _(spark, folder):
    return plain(cleaning.dedup_keep_last(_view(spark, folder)))


@query("stratified_split")
def _(spark, folder):
    return _split(spark, folder).select("order_id", "bad_score", "split")


@query("stratified_folds")
def _(spark, folder):
    return sampling.stratified_folds(_stored(_cleaned, spark, folder)).select("order_id", "bad_score", "fold")


@query("limit_rows")
def _(spark, folder):
    fv.create_feature_view(star_schema.relations(spark, folder))
    return fv.view_scan(spark, 1000).agg(F.count("*").alias("n_rows"))


@query("head")
def _(spark, folder):
    return plain(sampling.head(_cleaned(spark, folder)))


@query("drop_nulls")
def _(spark, folder):
    return plain(cleaning.drop_nulls(_view(spark, folder)))


@query("cast_day_columns")
def _(spark, folder):
    days = cleaning.cast_day_columns(cleaning.drop_nulls(_view(spark, folder)))
    return days.select("order_id", "review_id", *schemas.DAY_COLUMNS)


@query("clamp_processing_days")
def _(spark, folder):
    return cleaning.clamp_processing_days(_view(spark, folder)).select("order_id", "review_id", "processing_days")


@query("clean_data")
def _(spark, folder):
    return plain(cleaning.clean_data(_view(spark, folder)))


@query("cleaned_orders")
def _(spark, folder):
    """``clean_data`` planned from the tables; must give the same rows."""
    return plain(_cleaned(spark, folder))


@query("log_transform")
def _(spark, folder):
    logs = transform.log_transform(_cleaned(spark, folder))
    return rounded(logs.select("order_id", "log_total_price", "log_total_freight"), "log_total_price", "log_total_freight")


@query("clip_outliers")
def _(spark, folder):
    cleaned = _stored(_cleaned, spark, folder)
    return rounded(
        transform.clip_outliers(cleaned, transform.clip_bounds(cleaned)).select("order_id", *schemas.DAY_COLUMNS),
        *schemas.DAY_COLUMNS,
    )


@query("target_encode")
def _(spark, folder):
    encoding = transform.target_encoding(_train_rows(spark, folder))
    return rounded(encoding, "encoded", "prior")


def _transformed_output(df: DataFrame) -> DataFrame:
    measured = ["log_total_price", "log_total_freight", "category", *schemas.DAY_COLUMNS]
    return rounded(plain(df), *measured)


@query("order_transformer")
def _(spark, folder):
    """Fitted on the training part, applied to all cleaned orders."""
    split = _split(spark, folder)
    fitted = transform.OrderTransformer().fit(split.where("split = 'train'"))
    return _transformed_output(fitted.transform(split))


@query("validation_sample")
def _(spark, folder):
    test = _split(spark, folder).where("split = 'test'").drop("split")
    return sampling.validation_sample(test).select("order_id", "bad_score")


# --- models ----------------------------------------------------------------


def _prepared(spark: SparkSession, folder: str):
    return training.prepared(star_schema.relations(spark, folder))


def _settings(model_type: str) -> dict:
    return BOOSTED if models.model_choice(model_type) == "gbt" else FOREST


def _fitted(spark: SparkSession, folder: str, model_type: str):
    """(train rows, test rows, features, model)."""
    _, train, test = _prepared(spark, folder)
    features, _label = models.feature_label_split(train)
    return train, test, features, models.train(train, model_type, features, _settings(model_type))


@query("feature_label_split")
def _(spark, folder):
    """Feature names in order and the label, with the rows that have a value."""
    _, train, _test = _prepared(spark, folder)
    features, label = models.feature_label_split(train)
    return profile.null_counts(train, [*features, label]).withColumn(
        "role", F.when(F.col("column_name") == label, "label").otherwise("feature")
    )


def _held_out_confusion(name: str, model_type: str) -> None:
    def build(spark, folder):
        _train, test, features, model = _fitted(spark, folder, model_type)
        return evaluate.confusion_matrix(models.predict(test, model, features))

    query(name)(build)


_held_out_confusion("train_boosted_trees", "xgb")
_held_out_confusion("train_forest", "rf")


@query("feature_importances")
def _(spark, folder):
    _train, _test, features, model = _fitted(spark, folder, "rf")
    return models.feature_importances(model, features, spark)


@query("select_features")
def _(spark, folder):
    """Elimination down from all features on five folds of the training rows."""
    _, train, _test = _prepared(spark, folder)
    return selection.Selector(n_folds=5, params=ELIMINATION).fit(train).cv_results


@query("apply_selection")
def _(spark, folder):
    kept = [c for c in scoring.SCORING_COLUMNS if c != "log_total_freight"]
    return selection.apply_selection(_cleaned(spark, folder), kept)


def _searched(spark: SparkSession, folder: str, model_type: str, n_trials: int) -> dict:
    """Each trial draws all its values and has fits of its own."""
    _, train, _test = _prepared(spark, folder)
    chosen = models.model_choice(model_type)
    kept = selection.apply_selection(train, scoring.SCORING_COLUMNS)
    features = scoring.SCORING_COLUMNS
    return models.tune(kept, chosen, features, n_trials, 5, space=SPACE[chosen], parallelism=4, rounds_per_fit=1)


@query("search_space")
def _(spark, folder):
    """Ten drawn trials, each with its mean F1 over the folds of the training rows."""
    trials = _searched(spark, folder, "xgb", 10)["trials"]
    return trials.groupBy("trial", "params").agg(F.avg("f1").alias("mean_f1"))


def _tune(name: str, model_type: str) -> None:
    query(name)(lambda spark, folder: _searched(spark, folder, model_type, TRIALS[model_type])["trials"])


_tune("tune", "gbt")
_tune("tune_forest", "rf")


@query("refit")
def _(spark, folder):
    """Tuned on the training part, refitted on the test part, predictions of the latter."""
    _, train, test = _prepared(spark, folder)
    model = models.RiskModel("xgb", n_trials=5)
    model.tune_and_fit(train, scoring.SCORING_COLUMNS, n_folds=5, space=SPACE["gbt"])
    model.fit(test)
    return model.predict(test).select("order_id", "bad_score", "prediction")


@query("predict_label")
def _(spark, folder):
    _train, test, features, model = _fitted(spark, folder, "xgb")
    return models.predict(test, model, features).select("order_id", "bad_score", "prediction")


@query("predict_proba")
def _(spark, folder):
    _train, test, features, model = _fitted(spark, folder, "xgb")
    return models.predict(test, model, features).select("order_id", "bad_score", "probability")


@query("model_choice")
def _(spark, folder):
    """Held-out F1 of every spelling of the model types."""
    _, train, test = _prepared(spark, folder)
    features = scoring.SCORING_COLUMNS
    out = None
    for name in ("XGB", "rf"):
        model = models.train(train, name, features, _settings(name))
        row = evaluate.f1(models.predict(test, model, features)).select(
            F.lit(name).alias("asked"), F.lit(models.model_choice(name)).alias("model_type"), "f1"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("feature_impact")
def _(spark, folder):
    _train, test, features, model = _fitted(spark, folder, "xgb")
    return impact.permutation_importance(test, model, features)


@query("impact_by_decile")
def _(spark, folder):
    _train, test, features, model = _fitted(spark, folder, "xgb")
    return impact.impact_by_decile(test, model, features)


# --- scoring ---------------------------------------------------------------


def _order_inputs(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned orders as scoring inputs (weight in kilograms)."""
    return _cleaned(spark, folder).select(
        "order_id",
        "bad_score",
        "num_items",
        "desc_len",
        "category",
        (F.col("weight_g") / 1000.0).alias("weight_kg"),
        "delivery_days",
        "estimated_delivery_diff",
        F.col("total_freight").cast("double").alias("freight_value"),
    )


@query("scoring_features")
def _(spark, folder):
    return rounded(scoring.scoring_features(_order_inputs(spark, folder)), "weight_g", "log_total_freight")


@query("score_orders")
def _(spark, folder):
    fitted, train, _test = _prepared(spark, folder)
    model = models.train(train, "xgb", scoring.SCORING_COLUMNS, BOOSTED)
    inputs = scoring.scoring_features(_order_inputs(spark, folder))
    return scoring.score_orders(inputs, fitted, model).select("order_id", "bad_score", "probability")


@query("risk_decision")
def _(spark, folder):
    decided = scoring.risk_decision(_scored(spark, folder), 0.45)
    return decided.select("order_id", "probability", "risk_percent", "risk_level", "advice")


@query("risk_factors")
def _(spark, folder):
    found = scoring.risk_factors(_cleaned(spark, folder))
    return found.select("order_id", F.concat_ws("; ", "risk_factors").alias("risk_factors"))


@query("input_rules")
def _(spark, folder):
    return scoring.input_rules(_order_inputs(spark, folder))
