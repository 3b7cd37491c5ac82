"""Timed run of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=4 python bench.py

Each query's plan is executed in full with the ``noop`` sink (nothing collected to the driver).
The JVM is warmed up first with one base-table build on the smallest tables (not timed).
Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "abt", "first_order_spine", "reorder_label", "order_sequence", "review_dedup", "dominant_category",
    "payment_features", "dq_unique_key", "dq_orphans", "kpi_state", "kpi_monthly", "describe_numeric",
    "label_correlation", "abt_clean", "stratified_split", "roc_auc", "lift_table", "threshold_sweep",
    "train_classifier",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from firstbasket.plans.catalog import REGISTRY
    from firstbasket.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "8g"), app="firstbasket-bench")
    # Warm the JVM (class loading, code generation) once on the smallest tables, a different data
    # set from the one timed, so the first timed query is not charged for start-up.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        REGISTRY["abt"](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
