"""Benchmark the headline queries; prints ONE JSON line on stdout.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after two warm-ups, default 5),
BENCH_EVENT_LOG (optional folder: Spark writes its event log there, for stage
and task times without the UI).
Each run executes the full plan into Spark's ``noop`` sink (no driver
collect), and the median run is reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "route_statistics",
    "top_delayed_routes",
    "sliding_window_stats",
    "serving_merge",
    "window_stats",
    "speed_with_baseline",
    "serving_merge_history",
    "tumbling_window_avg",
    "clean_events",
    # streaming replays (availableNow over the whole events table, written and read back)
    "stream_sliding_window",
    "microbatch_stats",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    from headway.plans.catalog import QUERIES
    from headway.session import build_session

    extra = {"spark.driver.memory": "8g"}
    event_log = os.environ.get("BENCH_EVENT_LOG")
    if event_log:
        os.makedirs(event_log, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = build_session("headway-bench", master=f"local[{cpus}]", shuffle_partitions=cpus, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    events_rows = spark.read.parquet(os.path.join(sf_dir, "events.parquet")).count()

    times: dict[str, float] = {}
    for name in HEADLINE:
        q = QUERIES[name]
        for _ in range(2):                                                  # warm-up (JIT, caches)
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 4)
        print(f"{name}: {times[name]:.3f}s", file=sys.stderr, flush=True)

    total = round(sum(times.values()), 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "events_rows": events_rows,
        "rows_per_sec": {k: round(events_rows / v) for k, v in times.items() if v > 0},
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
