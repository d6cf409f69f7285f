"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores,
BENCH_RUNS how often each query is timed after one warm-up (the median counts),
BENCH_JIT=0 leaves the JVM's limit on compiled methods as a user's session has it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from censusloom.catalog.queries import queries  # noqa: E402

HEADLINE = [
    "base_population",
    "birth_month_all",
    "geo_ratio_epci",
    "geo_ratio_iris",
    "geo_ratio_canton",
    "student_flows_iris",
    "blend_epci",
    "blend_iris",
    "project_stable",
    "project_estimates",
    "disaggregate_iris",
    "expand_birth_month_iris",
    "level_stats",
    "top20_share",
    "full_build",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("censusloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # By default the JIT may compile long generated methods instead of interpreting them.
        .config("spark.driver.extraJavaOptions", "" if os.environ.get("BENCH_JIT") == "0" else "-XX:-DontCompileHugeMethods")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known, times = queries(), {}

    def run(name: str) -> float:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # One untimed pass over the longest query warms the JVM up.
    run("full_build")
    for name in HEADLINE:
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall clock",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
