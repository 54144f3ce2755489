"""Time the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from clinicpulse import session
from clinicpulse.operators import staging
from clinicpulse.registry import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "ingest_events", "ingest_row_id", "identity_mobile", "identity_booking", "identity_account",
    "presence_mobile_all", "presence_allowlist", "presence_goal", "presence_pageview",
    "mau_booking", "mau_account", "ytd_users", "recompute_months", "mau_from_events",
    "upsert_identity_merge", "upsert_presence_merge", "insert_if_absent",
    "revenue_month", "call_center_count", "online_appointments", "online_ratio", "yoy_revenue",
    "no_show_base", "no_show_report", "maintain_tables",
)


def main() -> None:
    spark = session.build(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
            staging.release(spark)
        # The first run warms the JVM up.
        times[name] = round(statistics.median(runs[1:] or runs), 3)
    print(
        json.dumps(
            {
                "metric": "median seconds per query, summed",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
