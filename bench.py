"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablegate.plans.registered import registry  # noqa: E402
from tablegate.session import get_session  # noqa: E402

HEADLINE = [
    "validate_reasons",
    "gate_report",
    "gate_accepted",
    "typed_json_violations",
    "flatten_series",
    "classify_responses",
    "payload_hashes",
    "surrogate_keys",
    "dedupe_latest",
    "hourly_fact",
    "daily_rollup",
    "dim_city",
    "upsert_result",
    "upsert_actions",
    "upsert_rerun",
    "incremental_merge",
    "skip_unchanged",
    "land_rerun",
    "quarantine_roundtrip",
    "check_unique_combination",
    "check_relationships",
    "check_reconcile",
    "check_calendar_gaps",
    "checks_summary",
    "run_summary",
    "ingest_units",
    "build_marts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("daily_rollup")  # warm the JVM
    seconds = {name: run(name) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)$", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )


if __name__ == "__main__":
    main()
