"""Time every registered query and print one JSON line.

Each query runs in full (its rows are computed and discarded by Spark's no-op
sink). After one warm-up run the median of the timed runs is reported. Queries
that land, ingest and rewrite tables run last and once, in the warm session.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from barloom.queries import REGISTRY
from barloom.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
STORAGE = {
    "bars_from_hourly",
    "bronze_listing",
    "bronze_metadata",
    "bronze_roundtrip",
    "gold_partition_overwrite",
    "gold_replace",
    "incremental_ingest",
    "medallion",
    "quarantine",
    "silver_date_lookup",
    "silver_append",
}


def run_once(spark, name: str) -> float:
    started = time.perf_counter()
    REGISTRY[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        conf={
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else sorted(REGISTRY, key=lambda name: name in STORAGE)
    seconds = {}
    for name in names:
        if name in STORAGE:
            seconds[name] = round(run_once(spark, name), 3)
        else:
            run_once(spark, name)
            seconds[name] = round(statistics.median(run_once(spark, name) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
