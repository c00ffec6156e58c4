"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Per query: one warm-up, then the median of BENCH_RUNS runs into the noop sink, so every row
is computed and none is collected. BENCH_ALL=1 times every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardwatch.plans import QUERIES  # noqa: E402
from cardwatch.session import build_session  # noqa: E402

HEADLINE = [
    "scan_project", "hourly_fraud_rate", "correlation_matrix", "card_profile_90d", "join_inner_features", "training_set",
    "rolling_features", "rolling_distinct", "ordinal_encode", "stratified_split", "class_report", "roc_auc", "lift_chart",
    "monitor_profile", "monitor_quality", "drift_psi", "drift_chi2", "drift_metrics", "alert_model_quality",
    "payload_records", "enforce_signature", "ab_resolve", "stream_monitor", "replace_partition",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for key in keys:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[key] = round(statistics.median(times[1:]), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
