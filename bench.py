"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Each query is warmed up once on the smallest tables next to BENCH_SF_DIR, then timed once.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "select_regex", "cast_columns", "case_bins", "filter_regex", "topk_per_group",
    "join_inner", "join_full", "join_semi",
    "agg_group_avg", "agg_describe", "agg_median", "agg_column_profile", "agg_missing_profile", "agg_histogram",
    "win_ntile", "win_rank_nth", "win_gap_to_max", "win_row_number",
    "sample_hash", "split_stratified", "impute_median",
    "fn_tokenize", "fx_idf", "fx_string_index", "fx_scale", "fx_pca",
    "stat_woe_iv", "stat_mono_bin", "stat_correlation", "stat_vif", "test_chisq", "stat_psi",
    "ev_classification", "ev_roc_auc", "ev_roc_points", "ev_decile_ks", "ev_gains_lift", "ev_regression",
    "ml_logistic_binary_many", "ml_decision_tree_cls_deep", "ml_random_forest_cls_deep", "ml_naive_bayes",
    "un_kmeans", "un_als", "auto_select",
]


def main() -> None:
    from tabloom.catalog import QUERIES
    from tabloom.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    names = sys.argv[1:] or HEADLINE
    run = lambda name, folder: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        if os.path.isdir(small):
            run(name, small)
        start = time.perf_counter()
        run(name, sf_dir)
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline query seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
