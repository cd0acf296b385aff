"""Benchmark the headline queries; prints ONE JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_RUNS`` (timed runs per query after one warm-up, default 3), ``BENCH_QUERIES``
(comma-separated subset). Each run executes the whole query into Spark's ``noop`` sink
(full execution, no collection to the driver); the reported time is the median run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gridline.plans import registry  # noqa: E402
from gridline.session import build_session  # noqa: E402

HEADLINE = [
    "fact_session_results", "v_constructor_reference", "v_constructor_evolution", "v_driver_evolution",
    "v_constructor_round_wins", "v_driver_round_wins", "v_driver_standings", "v_constructor_standings",
    "v_driver_stats", "v_constructor_stats", "v_constructor_drivers_distribution", "chart_driver_metrics",
    "chart_cumulative_series", "dedupe_keep_first", "dq_results", "medallion_backfill",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app_name="gridline-bench")
    qs = registry.queries()
    times: dict[str, float] = {}
    for name in names:
        fn = qs[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:                       # first run warms the JVM, caches and landing files
                samples.append(dt)
        times[name] = round(statistics.median(samples), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "runs": runs, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
