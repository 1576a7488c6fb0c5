"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line. Each query is fully executed
into Spark's ``noop`` sink (every row produced, nothing collected); the
reported time is the best of ``$BENCH_REPEATS`` runs (default 2) after a
warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskweave.plans.registry import load_all  # noqa: E402
from riskweave.session import local_session  # noqa: E402

HEADLINE = [
    "feat_full",
    "split_time_based",
    "eda_describe",
    "eda_rate_by_group",
    "metric_all",
    "threshold_sweep",
    "enc_processed_splits",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="riskweave-bench")
    reg = load_all()
    spark.read.parquet(os.path.join(sf_dir, "events.parquet")).count()  # warm-up
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeats):
            t0 = time.perf_counter()
            reg[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
