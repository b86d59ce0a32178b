"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.workloads import tables  # noqa: E402
from tidemark.workloads.queries import QUERIES  # noqa: E402

HEADLINE = [
    "resume_scan",
    "multiplexed_read",
    "partitioned_read",
    "committed_offsets",
    "mark_fold",
    "mixed_fold",
    "mixed_fold_sliced",
    "mixed_fold_by_user",
    "stash_fold",
    "delivery_audit",
    "range_assignment",
    "round_robin_assignment",
    "group_assignment_range",
    "rebalance_history",
    "stream_auto_commit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        begin = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - begin, 3)

    # Numbering the events as a stored log is timed by itself: the other queries read it.
    timed("ingest_event_log", lambda: tables.stored_log(spark, sf_dir))
    for name in only or HEADLINE:
        timed(
            name,
            lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save(),
        )
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
