"""Time the headline queries: one JSON line with warm seconds per query."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from querybook import QUERIES

HEADLINE = (
    "gld_plan_actual",
    "gld_dataset_japan",
    "gld_dataset_korea",
    "gld_attach_revenue_jan",
    "con_plan_actual",
    "con_union_scaled",
    "alc_support",
    "alc_bo",
    "alc_overhead",
    "slv_ledger_two_measure",
    "ing_date_detect",
    "ing_year_slice",
    "ing_replace_year",
    "dq_relationships",
)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
#: After so many seconds every query still gets its warm-up and one timed run.
SECONDS = float(os.environ.get("BENCH_SECONDS", "420"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    began = time.time()
    for name in HEADLINE:
        runs = []
        for k in range(RUNS + 1):  # the first run warms up
            if k > 1 and time.time() - began > SECONDS:
                break
            start = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(sf)}),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
