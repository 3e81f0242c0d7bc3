"""Benchmark of the headline queries.

Runs each query fully (``noop`` sink: every row is produced, nothing is
collected) at ``$BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) on
``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_REPS`` runs.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline import build_session  # noqa: E402
from ledgerline.plans.registry import QUERIES  # noqa: E402

HEADLINE = [
    # split side
    "transaction_ids", "split_reconcile",
    # silver
    "silver_enriched", "silver_scan",
    # gold
    "hourly_fraud_metrics", "victim_profile", "system_audit", "trends_detailed",
    # quality
    "unmatched_rows", "feed_completeness", "corrupt_rate",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def gold_refresh(spark, silver_path: str, one_pass: bool) -> float:
    """All four gold tables over a stored silver table, published to ``noop``."""
    from ledgerline.plans import gold_job

    def publish(df, name):
        df.write.format("noop").mode("overwrite").save()
    t0 = time.perf_counter()
    gold_job.run_gold(spark, silver_path, publish, one_pass=one_pass)
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", "ledgerline-bench", conf={
        "spark.sql.shuffle.partitions": str(max(int(cpus), 1) * 2),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        # one listing task per core, not one per step directory
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": cpus,
    })
    spark.sparkContext.setLogLevel("ERROR")
    results = {}
    for name in names:
        run_once(spark, name, sf_dir)                  # warm-up
        results[name] = round(statistics.median(
            run_once(spark, name, sf_dir) for _ in range(reps)), 3)
    if not sys.argv[1:]:
        # gold refresh over a silver table written once (setup, not timed)
        from ledgerline.plans.registry import _silver_table
        silver_path = _silver_table(spark, sf_dir)
        for label, one_pass in (("gold_refresh", False), ("gold_refresh_one_pass", True)):
            gold_refresh(spark, silver_path, one_pass)  # warm-up
            results[label] = round(statistics.median(
                gold_refresh(spark, silver_path, one_pass) for _ in range(reps)), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf}))


if __name__ == "__main__":
    main()
