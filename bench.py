"""Time the headline queries and print one JSON line.

Each query is built and run to the end (every output column of every row, no sink) after one warm-up run of the
flagship; the time covers building the plan, planning and execution.
"""

from __future__ import annotations

import json
import os
import time

from kerbside.catalog.queries import QUERIES
from kerbside.session import local_session

HEADLINE = (
    "otp_scan", "pm_schedule", "service_window", "zone_visits_window", "visit_match", "closest_visit",
    "arrival_choice", "otp_no_visits", "otp_report", "otp_summary", "prepare_raw", "uncovered_reconcile",
    "history_merge", "fill_down", "stop_requests", "stop_changes", "old_change_rule", "route_diff", "change_notes",
    "tripchange_report", "monitor_wide", "monitor_long",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(
        cpus,
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("otp_report")
    seconds = {name: run(name) for name in HEADLINE}
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
