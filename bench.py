"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR``: data directory; ``BENCH_CPUS``: cores; ``BENCH_QUERIES``: comma-separated names.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "kpi_assets",
    "recency_8_30",
    "never_seen",
    "acc_manufacturer",
    "fresh_model",
    "acc_mac",
    "fresh_user",
    "fresh_os",
    "fresh_entity",
    "fresh_responsible",
    "fresh_building",
    "fresh_all_30c",
    "compliance_failed",
    "support_uptodate",
    "os_name",
    "os_support_class",
    "patch_targeted",
    "patch_success_connected",
    "agent_latest",
    "unit_upsert",
    "daily_fact",
    "monthly_avg",
    "run_report_r014",
    "run_report_r026",
    "run_report_r031",
    "run_report_r035",
    "run_report_r039",
    "run_report",
)


def main() -> None:
    from checks.queries import queries
    from fleetgauge.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = local_session(cpus, app="fleetgauge-bench")
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    known["scan_table"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the JVM's code paths

    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline KPI queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
