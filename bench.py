"""Benchmark the headline queries.

Runs each query end to end from the raw parquet tables in $BENCH_SF_DIR
(default /root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one JSON
line: {"metric", "value" (sum of per-query medians, seconds), "unit",
"queries": {name: median seconds}, "build_sec" / "execute_sec" (medians of
the plan-construction and execution parts), "sf", "runs", "rows"}.

Each query is executed fully (``write.format("noop")``, so every row is
produced but nothing is shipped to the driver), once to warm up and then
$BENCH_RUNS times (default 3); the median is reported.  Each timed run
builds its plans and any materialized intermediates from the raw files again: the time is the
whole query, end to end, in a warm JVM.
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
    "weekly_summary",
    "regional_comparison",
    "silver_prices",
    "paged_ingest",
    "keyed_upsert",
    "snapshot_cards",
    "regional_position",
    "delivery_margins",
    "state_rollup",
    "fleet_totals",
    "surcharge_scenarios",
    "forecast_linear_seasonal",
    "forecast_additive",
    "surcharge_series",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from pricelens.plans.registry import all_queries
    from pricelens.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    qs = all_queries()
    names = only or [q for q in HEADLINE if q in qs]
    times: dict[str, float] = {}
    build: dict[str, float] = {}
    execute: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples, builds, runs_ = [], [], []
        for _ in range(runs):
            t0 = time.perf_counter()
            df = qs[name](spark, sf_dir)  # plan construction (incl. materialized parts)
            t1 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            t2 = time.perf_counter()
            samples.append(t2 - t0)
            builds.append(t1 - t0)
            runs_.append(t2 - t1)
        times[name] = round(statistics.median(samples), 3)
        build[name] = round(statistics.median(builds), 3)
        execute[name] = round(statistics.median(runs_), 3)
        rows[name] = qs[name](spark, sf_dir).count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "build_sec": build,
        "execute_sec": execute,
        "sf": float(m.group(1)) if m else sf_dir,
        "runs": runs,
        "cpus": cpus,
        "rows": rows,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
