"""Time the chosen form of some operators against the usual alternative, on the same table.

Prints one JSON line. BENCH_SF_DIR and BENCH_CPUS as for bench.py.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from bench import session
from prepmill.functions import TIME_OF_DAY, time_of_day
from prepmill.functions.bins import OUTSIDE
from prepmill.operators import confusion_rates, min_max

SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def python_label(x):
    """One call per row in a Python worker."""
    if x is None:
        return None
    for item in TIME_OF_DAY:
        above = x > item.low if item.open_low else x >= item.low
        below = x < item.high if item.open_high else x <= item.high
        if above and below:
            return item.label
    return OUTSIDE


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action, times: int = 3) -> float:
    taken = []
    for _ in range(times):
        start = time.perf_counter()
        action()
        taken.append(time.perf_counter() - start)
    return round(min(taken), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    clock = lines.select((F.col("l_orderkey") % 2500).cast("double").alias("clock"))
    label = F.udf(python_label, "string")

    def one_job_per_number():
        df = lines
        for name in SCALED:
            low = df.agg(F.min(name)).first()[0]
            high = df.agg(F.max(name)).first()[0]
            df = df.withColumn(name, (F.col(name) - low) / (high - low))
        run(df.select(*SCALED))

    judged = lines.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_quantity") > 30).cast("int").alias("p"),
    )

    def one_count_per_number():
        for y in (0, 1):
            of_class = judged.filter(F.col("y") == y)
            for part in (of_class, of_class.filter("y = p"), of_class.filter("y <> p")):
                part.count()

    found = {
        "bin_native": best(lambda: run(clock.select(time_of_day(F.col("clock"))))),
        "bin_python_udf": best(lambda: run(clock.select(label("clock")))),
        "min_max_one_aggregate": best(lambda: run(min_max(lines.select(*SCALED), SCALED))),
        "min_max_one_job_per_number": best(one_job_per_number),
        "rates_one_aggregate": best(lambda: run(confusion_rates(judged, "y", "p", 1))),
        "rates_one_count_per_number": best(one_count_per_number),
    }
    spark.stop()
    print(json.dumps(found))


if __name__ == "__main__":
    main()
