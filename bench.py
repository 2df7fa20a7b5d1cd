"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (folder of the tables), BENCH_CPUS (local cores),
BENCH_REPEATS (timed runs per query, the median counts), BENCH_QUERIES (names).
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from strataline.workloads import catalog  # noqa: E402

HEADLINE = (
    "warehouse_sales_by_country",
    "m1_crm_customers",
    "m2_crm_products",
    "m3_crm_sales",
    "m9_api_orders",
    "m10_dim_customers",
    "m11_dim_products",
    "m12_fact_sales",
    "q1_revenue_per_active_customer",
    "q3_top_decile_revenue_share",
    "q5_age_distribution",
    "q8_age_distribution_by_source",
    "q11_mean_profit_rate",
    "q12_favourite_category_by_country",
    "q13_total_sales",
    "q14_order_count",
    "q16_monthly_sales",
    "q17_monthly_ship_lag",
    "q21_top_categories",
    "q22_sales_by_country",
    "q23_sales_by_source",
    "kpi_all",
    "q25_quality_summary",
    "w2_max_per_composite_key",
    "w3_version_intervals",
    "o1_global_index",
    "j8_not_in",
    "dq12_unique_combination",
    "dq18_rules_stg_crm__sales_details",
    "dq18_rules_fact_sales_clean",
    "f3_capitalise_words",
    "fi7_order_ground_truth",
    "pr_column_profile",
)


def run(df: DataFrame) -> None:
    """Compute every row and column, and keep none."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or list(HEADLINE)
    scratch = tempfile.mkdtemp(prefix="strataline-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strataline-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", scratch)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    seconds: dict[str, float] = {}
    for name in names:
        run(queries[name](spark, folder))  # warm-up: code generation and file cache
        taken = []
        for _ in range(repeats):
            started = time.perf_counter()
            run(queries[name](spark, folder))
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "headline queries, total seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    spark.stop()
    shutil.rmtree(scratch, ignore_errors=True)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
