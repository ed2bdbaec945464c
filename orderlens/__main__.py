"""Command line: load inputs, train and save models, score stored orders.

    python -m orderlens etl CSV_FOLDER TABLE_FOLDER
    python -m orderlens train TABLE_FOLDER MODEL_FOLDER [--trials-gbt N] [--trials-rf N] [--folds N]
    python -m orderlens score TABLE_FOLDER MODEL_FOLDER OUTPUT_FOLDER [--model gbt|rf] [--threshold 0.5]
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from orderlens.operators import cleaning, sampling, scoring, transform
from orderlens.plans import etl, training
from orderlens.session import build_session
from orderlens.sources.tables import TableStore


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="orderlens")
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("etl")
    load.add_argument("csv_folder")
    load.add_argument("table_folder")
    train = commands.add_parser("train")
    train.add_argument("table_folder")
    train.add_argument("model_folder")
    train.add_argument("--trials-gbt", type=int, default=100)
    train.add_argument("--trials-rf", type=int, default=50)
    train.add_argument("--folds", type=int, default=5)
    train.add_argument("--seed", type=int, default=sampling.SEED)
    score = commands.add_parser("score")
    score.add_argument("table_folder")
    score.add_argument("model_folder")
    score.add_argument("output_folder")
    score.add_argument("--model", default="gbt")
    score.add_argument("--threshold", type=float, default=0.5)
    score.add_argument("--clip", action="store_true")
    return parser.parse_args()


def main() -> None:
    args = arguments()
    spark = build_session()
    store = TableStore(spark, args.table_folder)
    if args.command == "etl":
        status = etl.run_etl(spark, args.csv_folder, store).orderBy("position")
        status.show(truncate=False)
        raise SystemExit(0 if status.where("NOT ok").isEmpty() else 1)
    tables = etl.stored_relations(store)
    if args.command == "train":
        trials = {"gbt": args.trials_gbt, "rf": args.trials_rf}
        found = training.train_risk(tables, seed=args.seed, n_trials=trials, n_folds=args.folds)
        found.save(args.model_folder)
        print("features kept:", found.selector.features_to_keep_)
        for name, model in found.models.items():
            print(name, "best mean F1", round(model.best_score_, 3), model.best_params_)
            found.reports[name].show(truncate=False)
    else:
        assets = training.ScoringAssets.load(args.model_folder, (args.model,))
        rows = transform.log_transform(cleaning.scorable_orders(tables))
        scored = assets.score(rows, args.model, args.clip).select(
            "order_id", "num_items", "estimated_delivery_diff", "probability"
        )
        decided = scoring.risk_factors(scoring.risk_decision(scored, args.threshold))
        decided.withColumn("model", F.lit(args.model)).write.mode("overwrite").parquet(args.output_folder)


if __name__ == "__main__":
    main()
