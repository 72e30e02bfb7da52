"""Times the headline queries at $BENCH_SF_DIR and prints one JSON line.

Layer tables are built first and timed as build_*; every query after that is planned and
run in full (results go to Spark's noop sink). One untimed pass over the smallest data
warms the JVM.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from tallyhouse.plans.queries import all_queries
from tallyhouse.plans.workspace import close_workspaces, workspace
from tallyhouse.session import build_session

BUILDS = ("bronze", "silver", "profile_lines", "profile_counts", "dim_product", "dim_customer", "fact_sales")

QUERIES = (
    "profile_report", "bronze_load", "dedupe_records", "silver_clean", "silver_rejects", "line_numbers",
    "customer_transactions", "dim_customer", "product_metrics", "dim_product", "scd2_product", "fact_sales",
    "fact_incremental", "fact_daily", "referential_integrity", "pipeline_checks", "tests_not_null", "tests_unique",
    "layer_summary", "monthly_sales", "top_products", "top_customers", "exploration_summary", "profile_columns",
    "profile_numeric", "quality_scores", "revenue_analysis", "temporal_analysis",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tallyhouse-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR", "spark-warehouse/bench-shared"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    found, times = all_queries(), {}

    small = Path(sf_dir).parent / "sf0.001"
    if small.exists() and os.environ.get("BENCH_WARM", "1") == "1":
        for name in QUERIES:
            run(found[name](spark, str(small)))

    tables = workspace(spark, sf_dir)
    for name in BUILDS:
        start = time.perf_counter()
        getattr(tables, name)
        times[f"build_{name}"] = round(time.perf_counter() - start, 3)
    names = found if os.environ.get("BENCH_ALL") else QUERIES
    for name in names:
        start = time.perf_counter()
        run(found[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - start, 3)

    total = sum(times.values())
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    close_workspaces(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "retail lakehouse build and headline queries, wall time",
                "value": round(total, 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "raw_lines": rows,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
