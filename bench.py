"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores. Each
query is planned and collected once to warm up and then ``RUNS`` times; its figure
is the median. ``value`` is the sum of the medians.
"""

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loadglass.catalog import QUERIES
from loadglass.session import session

RUNS = 5

HEADLINE = [
    "endpoint_performance",
    "daily_metrics",
    "hourly_metrics",
    "service_summary",
    "peak_vs_offpeak",
    "response_time_stats",
    "response_by_hour",
    "requests_by_hour",
    "traffic_by_hour",
    "error_heatmap",
    "error_status_share",
    "status_distribution",
    "latency_histogram",
    "kpis",
    "summary_dashboard",
    "reject_report",
    "expected_vs_observed",
    "expected_error_rate",
    "sample_n",
    "sample_fraction",
]


def measure(spark, folder: str, name: str) -> float:
    def run() -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).collect()
        return time.perf_counter() - started

    run()
    return statistics.median(run() for _ in range(RUNS))


def scale(folder: str) -> float | None:
    found = re.search(r"sf([0-9.]+)/?$", folder)
    return float(found.group(1)) if found else None


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = session(
        "bench",
        f"local[{cpus}]",
        # Call-site capture costs several round trips per column expression.
        {"spark.python.sql.dataFrameDebugging.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    try:
        seconds = {name: round(measure(spark, folder, name), 4) for name in names}
    finally:
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median warm seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale(folder),
            }
        )
    )


if __name__ == "__main__":
    main()
