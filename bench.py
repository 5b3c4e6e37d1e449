"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print
one JSON line.  Each query is executed in full through the ``noop`` sink (no collect)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import get_spark  # noqa: E402
from tidemark.plans import catalog  # noqa: E402

HEADLINE = [
    "split_metrics",          # flagship: churn table -> split -> score -> metrics
    "prepared_features",      # cleaning + exact medians + one-hot
    "stratified_split",       # exact distributed stratified split
    "pr_curve",               # exact PR curve via distributed running sums
    "curve_summary",          # ROC AUC, AP, best threshold
    "threshold_sweep",        # 31-point grid in one aggregation
    "run_log",                # run table (12 runs) written and read back
    "champion_challenger",
    "windowed_metrics",       # events x scores, 7-day windows
    "feature_drift",
    "champion_history",
    "logreg_fit_scores",      # distributed L-BFGS fit on the train split, scored on valid
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", app="tidemark-bench", shuffle_partitions=max(8, cpus),
                      conf={"spark.driver.memory": "16g"})
    # warm-up on the smallest data set (nothing is cached for the timed one): JVM start
    # and JIT compilation are paid once per application, not per query
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        catalog.QUERIES["split_metrics"](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
