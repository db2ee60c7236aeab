"""Seconds per query and of the whole job; prints one JSON line.

Headline queries: median of warm runs. All other order-line queries: one run in the
warm session. The whole job (clean lines to star, reports and documents) runs once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
OTHERS = [
    "u03_product_performance", "u10_fact_sales", "t01_t11_time_features", "f06_sales_category",
    "p02_p09_customer_profile", "c10_cleaned", "k01_k16_rules", "k17_column_profile", "k19_outlier_summary",
    "g01_forecast_by_product", "g04_discount_caps", "b06_prior_year", "b09_customer_rank", "d01_kpi_cards",
]


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "20g")
        .config("spark.ui.enabled", "false")
        .config("spark.log.level", "ERROR")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    from commerce_engine import pipeline
    from commerce_engine.plans.registry import CATEGORIES, QUERIES, REGIONS, SEGMENTS, state_codes
    from commerce_engine.sources.star import BASE_COLS, OrderTables

    def run(name: str) -> float:
        return seconds(lambda: QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save())

    headline = [n for n in QUERIES if n.startswith("q")] + OTHERS
    asked = sys.argv[1:]
    taken = {}
    for name in asked or headline:
        run(name)
        taken[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    total = round(sum(taken.values()), 3)
    out = {"metric": "sum of median warm seconds of the headline queries", "value": total, "unit": "sec", "queries": taken}
    out["sf"] = os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")
    if not asked:
        taken |= {name: round(run(name), 3) for name in QUERIES if name not in taken}
        star = OrderTables(spark, FOLDER)
        with tempfile.TemporaryDirectory() as folder:
            expected = ("United States", REGIONS, SEGMENTS, CATEGORIES)
            work = lambda: pipeline.run(star.base_lines(*BASE_COLS), folder, expected, state_codes(star))
            out["whole_job_sec"] = round(seconds(work), 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
