"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query seconds.

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver).  The session is warmed up
first so JVM start-up is not charged to the first query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "hourly_trend", "clean_rows", "enrich_rows", "filter_chain", "place_filter", "category_search",
    "sort_hour_asc", "sort_frequency", "preview", "category_frequency", "category_counts", "top10_share",
    "category_share", "summary_stats", "hour_probability", "row_stats", "replicate3", "pivot_long",
    "pivot_wide", "heatmap_normalized", "density_grid", "map_points_type", "legend_type", "corr_matrix",
    "strongest_pairs", "cluster_count", "nearest_center", "cluster_summary", "label_index_freq",
    "stratified_split", "impute_mode", "confusion_matrix", "classification_report", "scenario_features",
    "scenario_expand", "prepare_job", "kmeans_fit", "rf_train_score", "scenario_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from placetime.plans import queries
    from placetime.session import local_session

    spark = local_session(cpus, int(os.environ.get("BENCH_PARTITIONS", "16")), "placetime-bench")
    qs = queries()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]
    # Warm-up: JVM, codegen caches and the file listing.
    qs["hourly_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
