"""Whole runs: clean, load and analyse, each writing its tables below a folder.

    spark-submit -m tradewind.plans.jobs transactions.csv products.csv out/
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import customers, distribution
from ..session import build_session, drop_stages
from ..sources.readers import SEQUENCE, broken_records, scan_text, try_scan, union_chunks
from ..sources.resolve import canonical_frame
from ..sources.sinks import export_rejects, read_file, replace_file, write_csv, write_table
from . import analysis, cleaning, dashboard, warehouse

Analysis = dict[str, Callable[[DataFrame, DataFrame], DataFrame]]

ANALYSES: Analysis = {
    "yearly_revenue_growth": lambda t, c: analysis.yearly_revenue_growth(t),
    "yearly_trend": lambda t, c: analysis.yearly_trend(t),
    "year_month_matrix": lambda t, c: analysis.year_month_matrix(t),
    "monthly_totals": lambda t, c: analysis.monthly_totals(t),
    "category_seasonality": analysis.category_seasonality,
    "top_growth_years": lambda t, c: analysis.top_growth_years(t),
    "rfm_segments": lambda t, c: customers.segment(customers.rfm(t)),
    "rfm_segment_summary": lambda t, c: customers.segment_summary(customers.segment(customers.rfm(t))),
    "rfm_recency_quartile": lambda t, c: customers.recency_quartile(customers.rfm(t)),
    "payment_monthly_counts": lambda t, c: analysis.payment_monthly_counts(t),
    "payment_monthly_share": lambda t, c: analysis.payment_monthly_share(t),
    "category_revenue": analysis.category_revenue,
    "category_share": analysis.category_share,
    "prime_order_value": lambda t, c: analysis.prime_order_value(t),
    "prime_frequency": lambda t, c: analysis.prime_frequency(t),
    "prime_category": analysis.prime_category,
    "state_revenue": lambda t, c: analysis.place_revenue(t, "customer_state"),
    "city_revenue": lambda t, c: analysis.place_revenue(t, "customer_city"),
    "festival_windows": lambda t, c: analysis.festival_windows(t),
    "age_group_spending": lambda t, c: dashboard.age_group_spending(t),
    "price_demand": analysis.price_demand,
    "price_demand_correlation": analysis.price_demand_correlation,
    "delivery_histogram": lambda t, c: distribution.histogram(t, "delivery_days", 40),
    "delivery_on_time": lambda t, c: analysis.delivery_on_time(t),
    "returns_summary": lambda t, c: analysis.returns_summary(t),
    "return_rating_correlation": lambda t, c: analysis.return_rating_correlation(t),
    "top_brands": analysis.top_brands,
    "brand_monthly": analysis.brand_monthly,
    "cohort_retention": lambda t, c: customers.cohort_retention(t),
    "cohort_value": lambda t, c: customers.cohort_value(t),
    "discount_rows": lambda t, c: analysis.discount_rows(t),
    "discount_trend": lambda t, c: analysis.discount_trend(t),
    "rating_histogram": lambda t, c: distribution.histogram(t, "rating", 20),
    "rating_by_product": lambda t, c: analysis.rating_by_product(t),
    "category_transitions": lambda t, c: customers.transitions(analysis.enrich(t, c, "category"), "category", "transaction_id"),
    "product_lifecycle": lambda t, c: analysis.product_lifecycle(t),
    "top_product_monthly": lambda t, c: analysis.top_product_monthly(t),
    "brand_price_box": analysis.brand_price_box,
    "kpis": lambda t, c: analysis.kpis(t),
    "monthly_order_value": lambda t, c: analysis.monthly_order_value(t),
    # dashboard sections
    "executive_summary": lambda t, c: dashboard.executive_summary(t),
    "month_monitor": lambda t, c: dashboard.month_monitor(t),
    "top_category": lambda t, c: dashboard.top_category(t),
    "category_share_of_rows": lambda t, c: dashboard.category_share(t),
    "category_performance": lambda t, c: dashboard.category_performance(t),
    "top_states": lambda t, c: dashboard.top_states(t),
    "monthly_revenue": lambda t, c: dashboard.monthly_revenue(t),
    "revenue_series": lambda t, c: dashboard.revenue_series(t),
    "discount_line": lambda t, c: dashboard.discount_line(t),
    "customers_by_year": lambda t, c: dashboard.customers_by_year(t),
    "festival_monthly": lambda t, c: dashboard.festival_monthly(t),
    "price_optimization": lambda t, c: dashboard.price_optimization(t),
    "describe_rfm": lambda t, c: dashboard.describe_customers(customers.rfm(t)),
    "top_products": lambda t, c: dashboard.top_products(t),
    "describe_rating": lambda t, c: dashboard.describe_rating(t),
    "payment_counts": lambda t, c: dashboard.value_counts(t, "payment_method", "method", 20),
    "return_counts": lambda t, c: dashboard.value_counts(t, "return_status", "status"),
}


class Run:
    """What a run has finished, kept in a file beside its outputs, so that a restart goes on where the last one stopped.

    ``of`` tells what the run is made from; another value starts anew.
    """

    def __init__(self, spark: SparkSession, folder: str, of: str):
        self.spark, self.path, self.of = spark, f"{folder}/run.json", of
        known = json.loads(read_file(spark, self.path) or "{}")
        self.done: list[str] = known["done"] if known.get("of") == of else []

    def step(self, name: str, work: Callable[[], object]) -> bool:
        """Do the work and note it, unless it is noted; whether it was done now."""
        if name in self.done:
            return False
        work()
        self.done.append(name)
        replace_file(self.spark, self.path, json.dumps({"of": self.of, "done": self.done}))
        return True


def inputs(spark: SparkSession, *paths: str) -> str:
    """Names, sizes and times of the files of some paths as one text; their content is not read."""
    told = []
    for path in paths:
        files = try_scan(lambda s, p: s.read.format("binaryFile").load(p), spark, path, required=False)
        mark = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
        told.append(f"{path}:{'absent' if files is None else files.agg(F.count(F.lit(1)), mark).first()}")
    return " ".join(told)


def clean(spark: SparkSession, transactions: str, products: str, folder: str, multiline: bool = False) -> None:
    """Raw CSV files to cleaned tables, reject tables, review tables and a summary.

    A missing input is skipped. The raw transactions are parsed once for all outputs. The place of
    each row in its file stays with it, for the load decides by it which row is the first.
    """
    counted = []
    for name, path, pipeline in (("transactions", transactions, cleaning.clean_transactions), ("products", products, cleaning.clean_products)):
        raw = try_scan(scan_text, spark, path, sequence=True, multiline=multiline, required=False)
        if raw is None:
            continue
        done = pipeline(raw, [SEQUENCE])
        outputs = {name: done.table, f"rejects/{name}": done.rejects.unionByName(broken_records(spark, path, multiline))}
        outputs |= {f"review/{name}-{review}": rows.drop(SEQUENCE) for review, rows in done.review.items()}
        for place, rows in outputs.items():
            write_table(rows, f"{folder}/{place}")
            written = spark.read.parquet(f"{folder}/{place}")
            counted.append(written.agg(F.count(F.lit(1)).alias("value")).select(F.lit(place).alias("metric"), "value"))
        rejects = spark.read.parquet(f"{folder}/rejects/{name}")
        counted.append(rejects.groupBy("rule").agg(F.count(F.lit(1)).alias("value")).select(F.concat(F.lit(f"rejects/{name}/"), "rule").alias("metric"), "value"))
        export_rejects(rejects, f"{folder}/rejected-texts/{name}")
    if counted:
        write_table(union_chunks(counted), f"{folder}/summary")


def load(spark: SparkSession, cleaned: str, folder: str, order: list[str], product_order: list[str] | None = None) -> DataFrame:
    """Cleaned tables to the star schema; returns the breaches found in it."""
    tables = warehouse.build(spark.read.parquet(f"{cleaned}/transactions"), spark.read.parquet(f"{cleaned}/products"), order, product_order)
    return warehouse.checks(warehouse.load(spark, tables, folder))


def run_all(
    transactions: DataFrame, catalog: DataFrame, folder: str, chosen: Analysis | None = None, csv: bool = False, run: Run | None = None,
) -> dict[str, str]:
    """Every question into its own table; a failing one is reported and does not stop the others.

    With ``run``, tables that it knows to be finished are kept.
    """
    def write(question: Callable[[DataFrame, DataFrame], DataFrame], place: str) -> None:
        table = question(transactions, catalog)
        write_csv(table, place) if csv else write_table(table, place)

    outcome = {}
    for name, question in (chosen or ANALYSES).items():
        place = f"{folder}/{name}"
        try:
            if run is None:
                write(question, place)
                outcome[name] = "written"
            else:
                outcome[name] = "written" if run.step(place, lambda: write(question, place)) else "kept"
        except (PySparkException, ValueError) as problem:
            outcome[name] = f"failed: {str(problem).splitlines()[0]}"
    return outcome


def main(transactions: str, products: str, folder: str) -> int:
    """The whole run, taken up again where an earlier one over the same files stopped; the number of questions that failed, which is the exit status."""
    spark = build_session("tradewind-run")
    run = Run(spark, folder, inputs(spark, transactions, products))
    run.step("clean", lambda: clean(spark, transactions, products, f"{folder}/cleaned"))
    run.step("load", lambda: write_table(load(spark, f"{folder}/cleaned", f"{folder}/warehouse", [SEQUENCE], [SEQUENCE]), f"{folder}/breaches"))
    tables = warehouse.loaded(spark, f"{folder}/warehouse")
    outcome = run_all(canonical_frame(tables["transactions"]), tables["products"], f"{folder}/results", run=run)
    for name, result in outcome.items():
        print(name, result)
    drop_stages(spark)
    return sum(result not in ("written", "kept") for result in outcome.values())


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:4]))
