"""Seconds per headline query on $BENCH_SF_DIR with $BENCH_CPUS cores; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cellrisk import catalog
from cellrisk.session import build_session, clear_scratch

HEADLINE = [
    "scan_subscribers", "feat_network_quality", "one_hot", "row_checks", "grid_cell", "cell_neighborhood",
    "nearest_tower", "towers_in_radius", "nearest_poi_by_type", "poi_density", "risk_grid", "observed_grid",
    "top_zones", "tier_breakdown", "concentration", "dq_report", "describe", "box_stats", "corr_matrix",
    "mutual_information", "psi", "classification_metrics", "threshold_sweep", "cumulative_gain", "gain_at_k",
    "cell_rate_leave_one_out", "cell_rate_lagged", "stratified_split", "tower_ingest", "score_stream",
    "stream_weekly_kpi", "feature_build", "train_gbt", "mutual_information_neighbours", "sample_per_class", "json_quarantine",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "cellrisk-bench",
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="16g",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    queries["kpi_overview"](spark, sf_dir).collect()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    clear_scratch(spark)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}
        )
    )


if __name__ == "__main__":
    main()
