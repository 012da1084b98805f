"""Benchmark: headline queries on the driver's tables.

Runs each query to completion with Spark's ``noop`` sink (the full plan
executes, nothing is collected to the driver) and prints one JSON line:
{"metric": ..., "value": total_seconds, "unit": "sec", "queries": {...}, "sf": ...}

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_REPEAT (default 3;
the best of N timed runs after one warm-up run is reported per query).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clinical_cohort.plans import registry  # noqa: E402
from clinical_cohort.session import get_session  # noqa: E402

HEADLINE = [
    "measure_first_last",
    "cohort_combined",
    "demographics_visit",
    "join_payer_interval",
    "qc_profile",
    "features_icd_levels",
    "feature_matrix",
    "rollup_conditions",
    "eval_roc",
    "eval_auc",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = get_session("clinical_cohort_bench", master=f"local[{cpus}]", conf={
        "spark.sql.shuffle.partitions": str(max(cpus * 2, 8)),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()

    # Warm-up: one untimed run of every query (JVM start, code generation,
    # parquet footer reads), then the timed runs.
    for name in names:
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        timings[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_headline_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
