"""Headline queries at ``$BENCH_SF_DIR``; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from costweave.plans.catalog import QUERIES
from costweave.session import build_session, clear_staging

HEADLINE = [
    "b6_promote_encounter",
    "b7_promote_resource",
    "i7_issue_summary",
    "h1_cost_pools",
    "h2_encounter_drivers",
    "d2_driver_totals",
    "d4_indirect_by_encounter",
    "h7_patient_level_cost",
    "h8_high_cost_flags",
    "h9_unallocated_by_reason",
    "h10_funding_comparison",
    "h14_encounter_funding",
    "h13_reconciliation_total",
    "j6_fact_patient_cost",
    "k3_encounter_checks",
    "m1_monthly_variance",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start-up cost belongs to no query
    QUERIES["h1_cost_pools"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    clear_staging(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
