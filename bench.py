"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is planned from the parquet files and executed in full with the
``noop`` sink (every row computed, nothing collected); the reported time
is the median of 3 runs after one warm-up. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["tableau_entries", "row_activity", "warehouse_utilization", "candidate_set_cost"]
EXTRA = ["best_set_per_scenario", "constraint_text", "cumulative_distribution", "expected_shipments"]


def run(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    from netloom.plans.registry import QUERIES
    from netloom.session import drop_scratch, local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = local_session(cpus, cpus * 2)
    names = HEADLINE + (EXTRA if os.environ.get("BENCH_EXTRA", "1") == "1" else [])
    times, errors = {}, {}
    for name in names:
        fn = QUERIES[name]
        try:
            run(spark, fn, sf_dir)  # warm-up
            times[name] = round(statistics.median(run(spark, fn, sf_dir) for _ in range(reps)), 3)
        except Exception as e:  # record and go on: one failure must not hide the other timings
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_total_median_sec",
        "value": round(sum(times[n] for n in HEADLINE), 3) if all(times[n] is not None for n in HEADLINE) else None,
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cores": cpus,
        "spark": spark.version,
    }
    if errors:
        out["errors"] = errors
    drop_scratch(spark)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
