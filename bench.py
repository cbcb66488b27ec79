"""Times the warehouse build and the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores. Results are written to
Spark's no-op sink, so every row is computed and none is collected. The layers are built once and
timed as queries of their own; a query's time is its best of two runs, and ``first`` has its first.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans.catalog import QUERIES
from tallyhouse.plans.warehouse import warehouse_of
from tallyhouse.session import build_session

HEADLINE = [
    "q01_monthly_revenue", "q02_payment_method_performance", "q03_top_merchants",
    "q04_weekend_weekday", "q05_top_customers", "q06_status_by_location",
    "q07_product_category", "q08_device_usage", "q09_day_of_week", "q10_failed_analysis",
    "dq_fk_nulls", "dq_txn_duplicates", "dq_measures", "dq_name_variations",
    "dq_status_distribution", "dq_batch_profile", "dq_clean_rows", "pit_lookup",
    "inc_upsert", "inc_hwm", "star_rollup",
    "dim_merchants", "dq_report", "catalog_build", "scd2_customers", "inc_cdc", "st_upsert",
    "gen_batch_profile", "inc_late_route", "inc_merge_on_read", "inc_fiscal_quarter",
    "distinct_by_month", "distinct_trailing_week",
]


def seconds(run) -> float:
    start = time.perf_counter()
    result = run()
    if isinstance(result, DataFrame):
        result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    return build_session(
        "tallyhouse-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    spark.sparkContext.setLogLevel("OFF")
    house = warehouse_of(spark, folder)
    timings = {
        "build_silver": seconds(lambda: house.silver and None),
        "build_dimensions": seconds(lambda: house.dims and None),
        "build_fact": seconds(lambda: house.fact and None),
    }
    first = {}
    for name in HEADLINE:
        run = QUERIES[name]
        runs = [seconds(lambda: run(spark, folder)) for _ in range(2)]
        first[name], timings[name] = round(runs[0], 3), min(runs)
    timings = {name: round(value, 3) for name, value in timings.items()}
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "build and headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "first": first,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
