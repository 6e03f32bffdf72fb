"""Dashboard sections: one result table each, over the canonical analytics frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import distribution
from ..operators.common import mean, present, ratio, revenue, scalar, top
from ..operators.reshape import melt
from ..sources.resolve import resolved
from .analysis import place_revenue

RUN_RATE_DAYS = 30


def in_period(df: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Rows of a year and/or month; no restriction where none is given."""
    return df.filter(_period(year, month))


def _period(year: int | None, month: int | None) -> Column:
    condition = F.lit(True)
    for name, wanted in (("order_year", year), ("order_month", month)):
        if wanted is not None:
            condition = condition & (F.col(name) == wanted)
    return condition


def top_category(df: DataFrame) -> DataFrame:
    """The category with the largest revenue, the first by name among equals."""
    totals = present(df, "category").groupBy("category").agg(revenue().alias("revenue"))
    return top(totals, 1, "revenue", "category")


def executive_summary(df: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Metric and value as number and text; growth compares with the same months of the year before.

    One pass adds up both periods per category, from which all sums and the largest category follow;
    only the customers are counted in a pass of their own.
    """
    now, before = _period(year, month), F.lit(False) if year is None else _period(year - 1, month)
    amount, earlier = F.when(now, F.col("final_amount")), F.when(before, F.col("final_amount"))
    per_category = df.filter(now | before).groupBy("category").agg(
        F.sum(amount).alias("_sum"), F.count(amount).alias("_amounts"), F.count_if(now).alias("_rows"), F.sum(earlier).alias("_before"))
    known = F.col("category").isNotNull() & (F.col("_rows") > 0)
    totals = per_category.agg(
        revenue("_sum").alias("total_revenue"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("orders"), ratio(F.sum("_sum"), F.sum("_amounts")).alias("avg_order_value"),
        F.sum("_before").alias("_before"), F.min(F.when(known, F.struct((-F.coalesce("_sum", F.lit(0))).alias("least"), "category"))).alias("_top"))
    named = totals.withColumns({
        "active_customers": scalar(in_period(df, year, month), F.count_distinct("customer_id")),
        "growth": F.lit(None).cast("double") if year is None else ratio(F.col("total_revenue") - F.col("_before"), F.col("_before")),
        "top_category": F.col("_top.category"),
    })
    numbers = ["total_revenue", "growth", "orders", "active_customers", "avg_order_value"]
    shown = {
        "total_revenue": fn.format_currency(F.col("total_revenue").cast("double")), "growth": fn.format_percent("growth"),
        "orders": F.format_number("orders", 0), "active_customers": F.format_number("active_customers", 0),
        "avg_order_value": fn.format_currency("avg_order_value"),
    }
    cells = [
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"), shown[n].alias("shown")) for n in numbers
    ] + [F.struct(F.lit("top_category").alias("metric"), F.lit(None).cast("double").alias("value"), F.coalesce("top_category", F.lit("N/A")).alias("shown"))]
    return named.select(F.inline(F.array(*cells)))


def latest_month(df: DataFrame, year: str | None = None) -> DataFrame:
    """The rows of the newest month. ``year`` names a column that holds the year of the order's date: the newest date is
    then looked for in the newest year alone, and a table that is partitioned by it is read for that year only."""
    if year is None:
        start = scalar(df, F.trunc(F.max("order_date").cast("date"), "MM"))
        return df.filter(F.col("order_date") >= start.cast("timestamp_ntz"))
    newest = df.filter(F.col(year) == scalar(df.filter("order_date is not null"), F.max(year)))
    start = scalar(newest, F.trunc(F.max("order_date").cast("date"), "MM"))
    return newest.filter(F.col("order_date") >= start.cast("timestamp_ntz"))


def month_monitor(df: DataFrame, year: str | None = None) -> DataFrame:
    """The newest month in the data: revenue, orders, customers and 30-day run rate; ``year`` as in ``latest_month``."""
    month = latest_month(df, year).groupBy(fn.year_month("order_date").alias("order_ym")).agg(
        revenue().alias("revenue"), F.count(F.lit(1)).alias("orders"), F.count_distinct("customer_id").alias("active_customers"),
        F.count_distinct(F.dayofmonth("order_date")).alias("days_seen"))
    return month.withColumn("run_rate", ratio(F.col("revenue"), F.col("days_seen")) * RUN_RATE_DAYS)


def target_alert(df: DataFrame, target: float, year: str | None = None) -> DataFrame:
    """The newest month's revenue against a target."""
    month = month_monitor(df, year).select("order_ym", "revenue", F.lit(float(target)).alias("target"))
    return month.withColumn("status", F.when(F.col("revenue").cast("double") < F.col("target"), "below target").otherwise("on track"))


def category_share(df: DataFrame, count: int = 6) -> DataFrame:
    totals = present(df, "category").groupBy("category").agg(revenue().alias("revenue"))
    strongest = top(totals, count, "revenue", "category")
    return strongest.withColumn("share", ratio(F.col("revenue"), scalar(strongest, F.sum("revenue"))))


def top_states(df: DataFrame, count: int = 20) -> DataFrame:
    """States by revenue; by number of rows where there are no amounts."""
    if resolved(df, "final_amount"):
        return place_revenue(df, "customer_state", count)
    totals = present(df, "customer_state").groupBy("customer_state").agg(F.count(F.lit(1)).alias("orders"))
    return top(totals, count, "orders", "customer_state")


def monthly_revenue(df: DataFrame) -> DataFrame:
    totals = present(df, "order_year", "order_month").groupBy("order_year", "order_month").agg(revenue().alias("revenue"))
    return totals.withColumn("order_ym", fn.year_month_label("order_year", "order_month"))


def discount_line(df: DataFrame) -> DataFrame:
    """Least-squares line of amount over discount percent."""
    percent = F.col("discount_percent")
    number = fn.strip_numeric(percent) if dict(df.dtypes)["discount_percent"] == "string" else percent
    return distribution.straight_line(present(df, "discount_percent", "final_amount"), number, F.col("final_amount"))


def customers_by_year(df: DataFrame) -> DataFrame:
    return present(df, "order_year").groupBy("order_year").agg(F.count_distinct("customer_id").alias("customers"))


def revenue_series(df: DataFrame) -> DataFrame:
    """Monthly revenue dated on the first of the month."""
    day = F.make_date("order_year", "order_month", F.lit(1))
    return monthly_revenue(df).select(day.alias("month_start"), "revenue").orderBy("month_start")


def category_performance(df: DataFrame, count: int = 25) -> DataFrame:
    totals = present(df, "category").groupBy("category").agg(revenue().alias("revenue"), F.count("order_date").alias("orders"))
    return top(totals, count, "revenue", "category")


def festival_monthly(df: DataFrame) -> DataFrame:
    """Monthly revenue of orders marked as festival sales, or of those that name a festival."""
    if resolved(df, "is_festival_sale"):
        marked = df.filter(fn.lenient_flag("is_festival_sale"))
    else:
        marked = present(df, "festival_name")
    return monthly_revenue(marked)


def price_optimization(df: DataFrame, price: str = "original_price_inr") -> DataFrame:
    """Mean price, orders and revenue per product."""
    number = fn.strip_numeric(price) if dict(df.dtypes)[price] == "string" else F.col(price)
    per_product = present(df, "product_id").withColumn("_price", number).groupBy("product_id").agg(
        mean("_price").alias("price"), F.count("order_date").alias("orders"), revenue().alias("revenue"))
    return per_product.dropna()


def age_group_spending(df: DataFrame) -> DataFrame:
    groups = present(df, "customer_age_group").groupBy("customer_age_group").agg(
        revenue().alias("total"), mean().alias("avg_amount"), F.count("final_amount").alias("orders"))
    return groups.dropna()


def top_products(df: DataFrame, count: int = 50) -> DataFrame:
    """Products by revenue; units are order lines, not pieces."""
    totals = present(df, "product_id").groupBy("product_id").agg(F.count("order_date").alias("units"), revenue().alias("revenue"))
    return top(totals, count, "revenue", "product_id")


def value_counts(df: DataFrame, name: str, alias: str, count: int | None = None) -> DataFrame:
    """Rows per known value, most frequent first."""
    totals = present(df, name).groupBy(F.col(name).alias(alias)).agg(F.count(F.lit(1)).alias("orders"))
    return top(totals, count, "orders", alias) if count else totals.orderBy(F.desc("orders"), alias)


def describe_customers(customers: DataFrame) -> DataFrame:
    return distribution.describe(customers, {"recency": 0, "frequency": 0, "monetary": 4})


def describe_rating(df: DataFrame) -> DataFrame:
    return distribution.describe(df, {"rating": 3})
