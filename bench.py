"""Times the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all).
Storing the inputs is timed apart and counted in the total; the other numbers are the
median of three runs after one warm-up, each run planned and executed anew.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from claimtide.queries import queries
from claimtide.sources.staged import stage

HEADLINE = [
    "latest_agency", "dominant_loss_cause", "legal_flags_by_claim_month",
    "earned_exposure_incremental", "premium_branch", "claims_branch", "emergence_full",
    "publish_roundtrip",
]
RUNS = 3


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName("claimtide-bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # One machine: its own folder serves as the shared one.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="claimtide-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = session(cpus)
    timings = {"stage_inputs": seconds(lambda: stage(spark, folder))}
    registered = queries()
    for name in HEADLINE:
        def run(query=registered[name]):
            query(spark, folder).write.format("noop").mode("overwrite").save()

        run()
        timings[name] = statistics.median(seconds(run) for _ in range(RUNS))
    spark.stop()
    print(json.dumps({
        "metric": "claims_emergence_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {name: round(t, 3) for name, t in timings.items()},
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
