"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is written out in full (to a sink that keeps nothing), once to warm
up and then timed; the best of two timed runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import registry  # noqa: E402

HEADLINE = (
    "idx_normdiff_all", "idx_ratio_evi_savi_ibi", "idx_tc_angles", "filter_date_halfopen", "join_save_first",
    "composite_percentiles", "harmonic_phase_amp", "composite_full", "terrain_slope_aspect", "focal_min", "focal_max",
    "cloud_mask", "s1_speckle", "s1_terrain", "distance_pairs", "strat_sample_exact_n", "split_train_test",
    "strat_sample_extraction", "argmax_landcover", "confusion_matrix", "accuracy_overall", "area_estimate_ci",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tessera-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run = lambda: registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # noqa: B023, E731
        run()
        best = float("inf")
        for _ in range(2):
            began = time.perf_counter()
            run()
            best = min(best, time.perf_counter() - began)
        times[name] = round(best, 3)
    spark.stop()
    scale = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale}))


if __name__ == "__main__":
    main()
