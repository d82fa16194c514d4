"""Time every registered query and print one JSON line.

BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from prepmill.catalog import ENTRIES


def session(cpus: str) -> SparkSession:
    work = tempfile.mkdtemp(prefix="prepmill-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("prepmill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.extraJavaOptions", f"-Dderby.stream.error.file={work}/derby.log")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(ENTRIES)
    spark = session(cpus)
    seconds(lambda: ENTRIES["agg_group_count2"].run(spark, folder))  # warm the JVM
    timings = {}
    for name in chosen:
        timings[name] = round(seconds(lambda: ENTRIES[name].run(spark, folder)), 3)
        print(f"{name} {timings[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
