"""Summarise the physical plans of registered queries: exchanges (shuffles),
broadcasts, windows, aggregates, Python stages and what each Parquet scan reads.

    python tools/plan_report.py [sf_dir] [name ...] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import get_spark  # noqa: E402
from tidemark.plans import catalog  # noqa: E402

DEFAULT = ["split_metrics", "stratified_split", "pr_curve", "curve_summary", "threshold_sweep",
           "windowed_metrics", "feature_drift", "champion_history", "extract_model_ref",
           "benchmark_leaderboard", "champion_challenger"]


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def summary(text: str) -> dict:
    lines = text.splitlines()
    scans = []
    for ln in lines:
        if "FileScan parquet" in ln or "Scan parquet" in ln:
            table = re.search(r"\[file:[^\]]*/([a-z_]+)\.parquet", ln)
            cols = re.search(r"ReadSchema: struct<([^>]*)>", ln)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", ln)
            scans.append((table.group(1) if table else "?", cols.group(1) if cols else "?",
                          pushed.group(1) if pushed else ""))
    return {
        "shuffle exchanges": sum("Exchange hashpartitioning" in ln or "Exchange rangepartitioning" in ln
                                 or "Exchange SinglePartition" in ln for ln in lines),
        "single-partition exchanges": sum("Exchange SinglePartition" in ln for ln in lines),
        "broadcasts": sum("BroadcastExchange" in ln for ln in lines),
        "sort-merge joins": sum("SortMergeJoin" in ln for ln in lines),
        "broadcast joins": sum("BroadcastHashJoin" in ln or "BroadcastNestedLoopJoin" in ln for ln in lines),
        "windows": sum(re.search(r"\bWindow \[", ln) is not None for ln in lines),
        "python stages": sum("ArrowEvalPython" in ln or "FlatMapGroupsInPandas" in ln or "BatchEvalPython" in ln
                             for ln in lines),
        "scans": scans,
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    spark = get_spark("local[8]", shuffle_partitions=8)
    # the static plan (before AQE re-planning): what the optimizer chose from statistics
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print(f"# Physical plans ({os.path.basename(sf)}, AQE off, before runtime re-planning)\n")
    for n in names:
        df = catalog.QUERIES[n](spark, sf)
        s = summary(plan_text(df))
        print(f"## {n}\n")
        for k, v in s.items():
            if k != "scans":
                print(f"- {k}: {v}")
        print("- scans:")
        for t, cols, pushed in s["scans"]:
            print(f"  - `{t}` reads `{cols}`" + (f"; pushed: `{pushed}`" if pushed else ""))
        print()


if __name__ == "__main__":
    main()
