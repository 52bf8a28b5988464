"""Times the headline queries on a warm local session and prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed passes over the queries, the median counts (default 2, after one warm-up pass)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.registry import QUERIES  # noqa: E402
from starloom.session import local_session  # noqa: E402

HEADLINES = [
    "mom_revenue",
    "fact_sales_pit",
    "customer_dim_scd2",
    "cohort_retention",
    "rfm_segments",
    "observation_daily",
    "group_outliers",
    "scd2_event_log",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    times: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(runs + 1):
        for name in names:
            begin = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name].append(time.perf_counter() - begin)
    seconds = {name: round(statistics.median(t[1:] or t), 3) for name, t in times.items()}
    result = {
        "metric": "total median seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
