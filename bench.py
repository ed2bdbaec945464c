"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlens.queries import QUERIES  # noqa: E402
from orderlens.session import build_session  # noqa: E402

HEADLINE = [
    "feature_view",
    "clean_data",
    "cleaned_orders",
    "constraint_audit",
    "describe_numeric",
    "correlation_matrix",
    "histogram",
    "box_stats",
    "tail_score_mix",
    "stratified_split",
    "stratified_folds",
    "order_transformer",
    "threshold_sweep",
    "clean_reviews",
    "etl_load",
    "train_boosted_trees",
    "score_orders",
]


def run(build, spark, folder: str) -> float:
    start = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    run(QUERIES["feature_view"], spark, folder)  # warm-up of the JVM, not counted
    seconds = {name: round(run(QUERIES[name], spark, folder), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
