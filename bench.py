"""Times the headline queries: prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the cores, BENCH_RUNS the most timed runs per
query after one untimed run (the median counts). A query is not repeated once it has taken
ENOUGH_SECONDS.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tabstudy.catalog import QUERIES
from tabstudy.session import build_session

ENOUGH_SECONDS = 8.0

HEADLINE = [
    "agg_04_categorical_profile",
    "agg_04_profile_documents",
    "agg_07_duplicates_all_columns",
    "agg_08_quantile",
    "agg_08_quantile_narrowed",
    "agg_09_iqr_report",
    "agg_10_describe",
    "agg_11_correlation",
    "viz_01_histogram_60",
    "viz_02_density",
    "viz_03_box",
    "viz_04_scatter_grid",
    "spl_01_random_split",
    "spl_02_stratified_split",
    "smp_01_oversample",
    "smp_02_undersample",
    "smp_03_weighted_bootstrap",
    "smp_04_synthetic_points",
    "fe_04_column_composition",
    "met_05_roc_auc",
    "met_06_roc_curve",
    "exp_03_model_split_metrics",
    "ml_01_logistic",
    "ml_04_ridge",
    "ml_06_random_forest",
    "ml_07_gradient_boosting",
    "ml_08_neural_regressor",
    "exp_01_balancing",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "tabstudy-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "20g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in chosen:
        timed = []
        while len(timed) <= runs and (len(timed) < 2 or sum(timed[1:]) < ENOUGH_SECONDS):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            timed.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(timed[1:]), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
