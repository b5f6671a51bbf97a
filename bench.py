"""Bench: headline entries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Each entry is fully computed into Spark's ``noop`` sink (no driver collect):
one untimed warm-up pass over all entries (``BENCH_WARMUP``), then
``BENCH_REPEATS`` timed runs each; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "clean_trips", "cleaning_audit", "fleet_pressure", "opportunity_scores", "fleet_recommendations",
    "sql_corridors", "sql_fleet_pressure", "fk_integrity", "missing_values", "dataset_profile",
    "kpis", "eda_zone", "analysis_set", "logit_coefficients",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    from zonecast.plans.registry import QUERIES
    from zonecast.session import local_session

    spark = local_session(cpus)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for _ in range(int(os.environ.get("BENCH_WARMUP", "1"))):  # JIT and codegen warm-up
        for name in HEADLINE:
            run(name)
    timings = {}
    for name in HEADLINE:
        timings[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_total_median", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus, "repeats": repeats}))


if __name__ == "__main__":
    main()
