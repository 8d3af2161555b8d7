"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma-separated names, or "all") choose what is run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tillsight.plans import QUERIES
from tillsight.session import build_session

HEADLINE = [
    "silver_features", "j1_assemble", "a1_rfm", "a10_describe_features", "a17_score_distribution", "w1_top_categories",
    "w3_deciles", "w3_deciles_hot_score", "r1_lift_table", "r3_retrain_decision", "v1_auc", "v4_evaluate", "g4_selection_report",
    "d1_psi_reference", "d2_psi_joint", "d5_psi_history", "q7_validate_suite", "q9_feature_counters", "l2_random_split",
    "l7_label_percentile", "l9_time_folds", "m4_silhouette", "e1_score_all", "e3_explain", "s1_read_txn_stream", "k3_replace_partitions",
    "b1_bi_segments", "t1_fit_lr", "t4_fit_gbt",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "tillsight-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
        **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"), "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["a12_value_counts"](spark, sf_dir).collect()  # start-up is not measured
    times = {}
    for name in names:
        start = time.perf_counter()
        # The whole result is produced, but not carried to the driver.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
