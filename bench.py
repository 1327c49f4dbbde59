"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts, and ``spread`` gives the
slowest run over the fastest. A run computes every output column and row. The star is built and
stored once; the KPIs are timed on the stored star, and the build as ``build_star``.
"""

import json
import os
import statistics
import time

from wardstream.operators.kpis import KPIS, Star
from wardstream.plans.registry import QUERIES, star
from wardstream.session import local_session, materialise

HEADLINE = [
    "silver",
    "latest_encounter",
    "dim_department",
    "build_star",
    "fact_by_visit",
    "scd2_apply",
    "scd2_history",
    "bed_occupancy",
    "bed_turnover_rate",
    "patient_demographics",
    "avg_treatment_duration",
    "patient_volume_trend",
    "department_inflow",
    "overstay_patients",
    "dq_profile",
    "gold_refresh",
    "stream_silver",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session("bench", cpus)
    stored = {}

    def store() -> None:
        built = star(spark, sf_dir)
        tables = {n: materialise(getattr(built, n), n) for n in ("fact", "patients", "departments")}
        stored["star"] = Star(**tables)

    def run(name: str) -> None:
        if name == "build_star":
            store()
            return
        df = KPIS[name](stored["star"]) if name in KPIS else QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()

    store()
    times, spread = {}, {}
    for name in names:
        seen = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            run(name)
            seen.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seen[1:]), 3)
        spread[name] = round(max(seen[1:]) / min(seen[1:]), 2)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "spread": spread,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
