"""Timings of the headline queries: one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.registry import QUERIES  # noqa: E402
from tradewind.session import build_session, drop_stages, shared_folder  # noqa: E402

HEADLINE = [
    "yearly_revenue_growth", "pivot_year_month", "category_seasonality", "rfm", "payment_monthly_share", "category_revenue",
    "prime_category", "state_revenue", "festival_windows", "age_spending", "corr_price_demand", "hist_delivery", "returns_summary",
    "brand_monthly_top5", "cohort_retention", "cohort_clv", "discount_trend", "rating_by_product", "category_transitions",
    "product_lifecycle", "brand_price_box", "kpis", "executive_summary", "month_monitor", "rfm_recency_quartile", "describe_rfm",
    "clean_date", "clean_price", "dedupe_transactions", "price_outliers_fixed", "clean_transactions", "clean_products",
    "dim_customers", "dim_time", "fact_transactions", "category_transitions_timed", "enrich_category", "enrich_brand",
    "avg_price_joinback", "rejects_all", "cleaning_summary", "warehouse_load", "warehouse_rejects", "rfm_segments",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("tradewind-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false",
                          spark__checkpoint__dir=os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="tradewind-bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    shared_folder(spark)
    times = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        taken = []
        for _ in range(runs + 1):  # the first run warms up
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
            drop_stages(spark)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(folder).name.removeprefix("sf"), "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
