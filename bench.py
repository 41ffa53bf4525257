"""Times the headline queries and prints one JSON line (median of three runs each)."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from railweave.plans.catalog import QUERIES
from railweave.session import build_session

HEADLINE = [
    "delay_features",
    "ml_delay_training",
    "historical_route_delay",
    "schedule_features",
    "current_vehicles",
    "route_options",
    "route_summary",
    "latency_distribution",
    "throughput_totals",
    "production_snapshot",
    "training_profile",
    "dq_report",
    "decode_validate",
    "idempotent_insert",
    "flatten_feed",
    "stream_to_table",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(spark, name: str, data_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, data_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "railweave-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{data_dir}/events.parquet").count()
    timings = {}
    for name in HEADLINE:
        # A stream costs a run of many batches, so one after a warm-up by the others is enough.
        runs = 1 if name.startswith("stream") else RUNS
        timings[name] = round(statistics.median(seconds(spark, name, data_dir) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(data_dir.rstrip("/")).removeprefix("sf"),
                "events": rows,
                # Every message is sent twice.
                "stream_rows_per_sec": round(2 * rows / timings["stream_to_table"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
