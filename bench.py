"""Time the registered queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query runs once to warm up, then ``$BENCH_RUNS`` times; its time is the median. Results
are written to a sink that keeps nothing, so every row is computed. Prints one JSON line.
``python bench.py name ...`` times the named queries only.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from layerwise.queries import QUERIES  # noqa: E402
from layerwise.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
#: Queries whose first run takes longer, the flows, are timed once.
LONG = 5.0
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    tracker = spark.sparkContext.statusTracker()
    times: dict[str, float] = {}
    jobs: dict[str, int] = {}

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in sys.argv[1:] or QUERIES:
        spark.sparkContext.setJobGroup(name, name)
        first = run(name)
        jobs[name] = len(tracker.getJobIdsForGroup(name))
        times[name] = round(statistics.median(run(name) for _ in range(1 if first > LONG else RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "jobs": jobs,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
