"""Time the registered queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (threads), BENCH_RUNS (timed runs per query, the median counts),
BENCH_ONLY (comma-separated names, or "all"). Each query is warmed up once, on the smallest tables next to the timed ones.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tabforge.queries import QUERIES  # noqa: E402

# One or more of every family: scans, features, joins, profiles, splits, scores, estimators, ensembles.
HEADLINE = """
flagship classify_and_score
src_csv_typed parse_ts_multi
drop_near_constant drop_low_variance impute_mean
join_left_dim join_left_salted join_left_hot join_left_composite range_join
row_norm weighted_sum bin_floor flatten_array
label_encode split_phrases phrase_vocab
nunique_by_group profile_merged describe_numeric mode_frequency corr_matrix histogram_by_class kde_by_group cov_ellipse
standardize_train_test stratified_split stratified_kfold kfold_assign cap_rows
metric_class_report metric_auc_macro
clf_gaussian_nb clf_lda_2d clf_qda knn_classify knn_loo_accuracy tune_knn
pca_scores kmeans_groups clf_logistic clf_linear_svm clf_tree clf_forest clf_extra_trees clf_gbt clf_adaboost clf_mlp
cv_scores_nb oof_nb per_group_nb vote_majority stack_oof
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    picked = [k for k in os.environ.get("BENCH_ONLY", "").split(",") if k] or HEADLINE
    if picked == ["all"]:
        picked = list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.openCostInBytes", "1m")  # the test files are small
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    small = small if os.path.isdir(small) else folder
    times = {}
    for key in picked:
        QUERIES[key](spark, small).write.format("noop").mode("overwrite").save()
        took = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[key] = round(statistics.median(took), 3)
        print(f"{key:26s} {times[key]:8.3f}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, warm",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
