"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Each query is executed completely through the ``noop`` sink (no collect to
the driver); the time includes any small eager jobs the operator runs while
planning (quantile sketches, bounds).  A warm-up query is run first so JVM
start-up and class loading are not charged to the first query.  ``queries``
holds the first run of each, ``warm`` the second.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "find_optimal_threshold",
    "compute_metrics",
    "roc_curve",
    "recall_analysis",
    "profit_curve",
    "business_cost_analysis",
    "model_comparison",
    "strategy_compare",
    "describe",
    "outlier_report",
    "clean_data",
    "dedup_rows",
    "conversion_by_category",
    "cardinality_report",
    "stratified_split",
    "assemble_features",
    "decision_zones",
    "tier_rules",
    "zone_profile",
    "batch_score",
    "top_leads",
    "roc_auc_continuous",
    "kmeans_tiers",
    "assemble_sparse",
    "train_lr",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from leadlens.plans import catalog  # noqa: F401
    from leadlens.plans.registry import QUERIES
    from leadlens.session import clear_scratch, local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="leadlens-bench")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("confusion")  # warm-up
    times, warm = {}, {}
    for n in names:
        times[n] = round(run(n), 3)
        warm[n] = round(run(n), 3)
        clear_scratch(spark)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec", "queries": times, "warm": warm, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
