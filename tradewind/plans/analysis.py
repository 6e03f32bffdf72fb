"""The analysis questions: transactions (and catalog) in, one result table out.

Catalog attributes are joined after the orders have been added up per product, so the join sees
one row per product and a best-seller weighs no more than any other product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn
from ..functions import lexicon as lx
from ..operators import distribution
from ..operators.common import growth, mean, present, ratio, revenue, scalar, top
from ..operators.reshape import melt, share_of, spread_months
from ..operators.skew import attach
from ..session import staged
from ..sources.resolve import resolved

TIE = "transaction_id"


# --- catalog attributes -------------------------------------------------------------------------


def catalog_values(catalog: DataFrame, *names: str) -> DataFrame:
    """One row per product; should a product appear twice, its smallest known value counts."""
    return present(catalog, "product_id").groupBy("product_id").agg(*[F.min(n).alias(f"catalog_{n}") for n in names])


def _named(df: DataFrame, name: str) -> Column:
    """The catalog's value, else the transaction's own."""
    own = [F.col(name)] if name in df.columns else []
    return F.coalesce(F.col(f"catalog_{name}"), *own)


def enrich(df: DataFrame, catalog: DataFrame, name: str) -> DataFrame:
    """Every transaction with a catalog attribute, safe against products with very many orders."""
    joined = attach(df, catalog_values(catalog, name), ["product_id"], [f"catalog_{name}"], spread_by=[TIE] if TIE in df.columns else None)
    return joined.withColumn(name, _named(df, name)).drop(f"catalog_{name}")


def product_totals(df: DataFrame, catalog: DataFrame, names: list[str], *keys: Column | str) -> DataFrame:
    """Orders and revenue per product and further keys, with catalog attributes."""
    own = [n for n in names if n in df.columns]
    totals = df.groupBy("product_id", *own, *keys).agg(F.count(F.lit(1)).alias("orders"), revenue().alias("revenue"))
    joined = totals.join(catalog_values(catalog, *names), "product_id", "left")
    return joined.withColumns({n: _named(totals, n) for n in names}).drop(*[f"catalog_{n}" for n in names])


def revenue_by_attribute(df: DataFrame, catalog: DataFrame, name: str, *keys: Column | str) -> DataFrame:
    totals = product_totals(df, catalog, [name], *keys)
    others = [c for c in totals.columns if c not in ("product_id", "orders", "revenue", name)]
    return present(totals, name, *others).groupBy(name, *others).agg(F.sum("revenue").alias("revenue"))


# --- revenue over time --------------------------------------------------------------------------


def annual_revenue(df: DataFrame) -> DataFrame:
    return present(df, "order_year").groupBy(F.col("order_year").alias("year")).agg(revenue().alias("revenue"))


def yearly_revenue_growth(df: DataFrame) -> DataFrame:
    """Revenue per year with its change in percent; 0 in the first year, NULL after a year without."""
    years = Window.orderBy("year")  # one row per year
    before = F.lag("revenue").over(years)
    change = F.when(F.row_number().over(years) == 1, F.lit(0.0)).otherwise(growth(F.col("revenue"), before) * 100)
    return annual_revenue(df).select("year", "revenue", change.alias("pct_growth")).orderBy("year")


def yearly_trend(df: DataFrame) -> DataFrame:
    return distribution.straight_line(annual_revenue(df), F.col("year"), F.col("revenue"), 2, 0)


def top_growth_years(df: DataFrame, count: int = 3) -> DataFrame:
    return top(yearly_revenue_growth(df), count, "pct_growth", "year")


def year_month_matrix(df: DataFrame) -> DataFrame:
    matrix = spread_months(present(df, "order_year", "order_month"), "order_year", "order_month", F.sum("final_amount"))
    return matrix.orderBy("order_year")


def monthly_totals(df: DataFrame) -> DataFrame:
    totals = present(df, "order_month").groupBy("order_month").agg(revenue().alias("revenue"))
    return totals.orderBy(F.desc("revenue"), "order_month")


def category_seasonality(df: DataFrame, catalog: DataFrame, count: int = 6) -> DataFrame:
    """Year by month matrix of each of the strongest categories.

    A category carries its months (one entry per calendar month) through the ranking, so the
    orders are read once.
    """
    cells = revenue_by_attribute(df, catalog, "category", "order_year", "order_month")
    packed = cells.groupBy("category").agg(
        F.sum("revenue").alias("total"), F.collect_list(F.struct("order_year", "order_month", "revenue")).alias("months"))
    strongest = top(packed, count, "total", "category").select("category", F.inline("months"))
    months = {f"m{m:02d}": F.coalesce(F.sum(F.when(F.col("order_month") == m, F.col("revenue"))), F.lit(0)) for m in range(1, 13)}
    return strongest.groupBy("category", "order_year").agg(*[value.alias(name) for name, value in months.items()])


# --- payment, categories, prime, places ---------------------------------------------------------


def payment_monthly_counts(df: DataFrame) -> DataFrame:
    month = fn.year_month("order_date").alias("order_ym")
    return present(df, "order_date", "payment_method").groupBy(month, "payment_method").agg(F.count(F.lit(1)).alias("orders"))


def payment_monthly_share(df: DataFrame) -> DataFrame:
    return payment_monthly_counts(df).select("order_ym", "payment_method", share_of("orders", "order_ym").alias("share"))


def category_revenue(df: DataFrame, catalog: DataFrame, count: int | None = None) -> DataFrame:
    totals = revenue_by_attribute(df, catalog, "category")
    return top(totals, count, "revenue", "category") if count else totals.orderBy(F.desc("revenue"), "category")


def category_share(df: DataFrame, catalog: DataFrame, count: int = 10) -> DataFrame:
    """Share of each of the strongest categories in their common revenue."""
    strongest = category_revenue(df, catalog, count)
    return strongest.withColumn("share", share_of("revenue"))


def prime_order_value(df: DataFrame) -> DataFrame:
    flag = fn.lenient_flag("is_prime_member").alias("is_prime")
    return df.groupBy(flag).agg(revenue().alias("total"), F.count("final_amount").alias("orders"), mean().alias("avg_order_value"))


def prime_frequency(df: DataFrame) -> DataFrame:
    """Mean number of orders per customer, by membership."""
    per_customer = present(df, "customer_id").groupBy("customer_id", fn.lenient_flag("is_prime_member").alias("is_prime")).agg(
        F.count(F.lit(1)).alias("orders"))
    return per_customer.groupBy("is_prime").agg(ratio(F.sum("orders"), F.count(F.lit(1))).alias("avg_orders_per_customer"))


def prime_category(df: DataFrame, catalog: DataFrame) -> DataFrame:
    flag = fn.lenient_flag("is_prime_member").alias("is_prime")
    return revenue_by_attribute(df, catalog, "category", flag)


def place_revenue(df: DataFrame, place: str, count: int | None = None) -> DataFrame:
    totals = present(df, place).groupBy(place).agg(revenue().alias("revenue"))
    return top(totals, count, "revenue", place) if count else totals.orderBy(F.desc("revenue"), place)


# --- festivals ----------------------------------------------------------------------------------


def default_calendar(df: DataFrame) -> DataFrame:
    """One festival per year of the data, on the fixed day."""
    month, day = lx.FESTIVAL_MONTH_DAY
    years = present(df, "order_year").select(F.col("order_year").alias("year")).distinct()
    return years.select(
        F.lit("Diwali").alias("festival"), "year", F.make_date("year", F.lit(month), F.lit(day)).alias("anchor"),
        F.lit(lx.FESTIVAL_BEFORE).alias("days_before"), F.lit(lx.FESTIVAL_DURING).alias("days_during"),
        F.lit(lx.FESTIVAL_AFTER).alias("days_after"))


def festival_windows(df: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Revenue before, during and after each festival, 0 where there is none.

    before: [anchor - b, anchor), during: [anchor, anchor + d], after: (anchor + d, anchor + a].
    The orders are added up per day first; the calendar is laid out in days, so the two meet in an
    equality join of two small tables.
    """
    calendar = default_calendar(df) if calendar is None else calendar
    day = F.to_date("order_date")
    # an order with a time of day lies past the end of a window that closes at midnight
    closing = F.when(F.col("order_date").cast("timestamp_ntz") > day.cast("timestamp_ntz"), F.date_add(day, 1)).otherwise(day)
    daily = present(df, "order_date").groupBy(day.alias("day"), closing.alias("closing")).agg(revenue().alias("amount"))
    days = F.explode(F.sequence(F.date_sub("anchor", F.col("days_before")), F.date_add("anchor", F.col("days_after")))).alias("day")
    laid = calendar.select("festival", "year", "anchor", "days_during", "days_after", days)
    found = laid.join(daily, "day", "left")
    end_during, end_after = F.date_add("anchor", F.col("days_during")), F.date_add("anchor", F.col("days_after"))
    windows = {
        "before": F.col("day") < F.col("anchor"),
        "during": (F.col("day") >= F.col("anchor")) & (F.col("closing") <= end_during),
        "after": (F.col("closing") > end_during) & (F.col("closing") <= end_after),
    }
    return found.groupBy("festival", "year").agg(*[
        F.coalesce(F.sum(F.when(inside, F.col("amount"))), F.lit(0)).alias(f"revenue_{name}") for name, inside in windows.items()])


def festival_long(df: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    values = ["revenue_before", "revenue_during", "revenue_after"]
    return melt(festival_windows(df, calendar), ["festival", "year"], values, "period", "revenue")


# --- age, price, delivery, returns --------------------------------------------------------------


def age_spending(df: DataFrame, age: str = "customer_age") -> DataFrame:
    """Spending per age bucket; buckets nobody falls into are kept."""
    spent = df.groupBy(fn.age_bucket(fn.to_number(F.col(age))).alias("age_bucket")).agg(
        revenue().alias("total"), F.count("final_amount").alias("orders"), mean().alias("avg_amount"))
    labels = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, lx.AGE_LABELS))).alias("age_bucket"))
    return labels.join(spent, "age_bucket", "left").select(
        "age_bucket", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("orders", F.lit(0)).alias("orders"), "avg_amount")


def price_demand(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog price, orders and revenue per product; a catalog without prices gives mean order value."""
    orders = F.count(TIE if TIE in df.columns else "order_date").alias("orders")
    totals = present(df, "product_id").groupBy("product_id").agg(orders, revenue().alias("revenue"), mean().alias("_mean"))
    if resolved(catalog, "price"):
        totals = totals.join(catalog_values(catalog, "price"), "product_id", "left").withColumnRenamed("catalog_price", "price")
    else:
        totals = totals.withColumn("price", F.col("_mean"))
    return totals.select("product_id", "price", "orders", "revenue").filter("price is not null")


def price_demand_correlation(df: DataFrame, catalog: DataFrame) -> DataFrame:
    return distribution.correlation_matrix(price_demand(df, catalog), ["price", "orders", "revenue"])


def with_product_mean(df: DataFrame) -> DataFrame:
    """Every transaction with the mean order value of its product."""
    means = df.groupBy("product_id").agg(F.count(F.lit(1)).alias("rows"), mean().alias("avg_order_price"))
    return attach(df, means, ["product_id"], ["avg_order_price"], spread_by=[TIE])


def delivery_on_time(df: DataFrame, days: int = lx.ON_TIME_DAYS) -> DataFrame:
    number = fn.to_number("delivery_days")
    return df.agg(F.count(number).alias("orders"), F.count_if(number <= days).alias("on_time"),
                  ratio(F.count_if(number <= days), F.count(number)).alias("on_time_share"))


def returns_summary(df: DataFrame) -> DataFrame:
    return present(df, "return_status").groupBy("return_status").agg(
        F.count("final_amount").alias("orders"), revenue().alias("revenue"))


def return_rating_correlation(df: DataFrame) -> DataFrame:
    complete = df.select("return_status", "rating", "final_amount").dropna()
    flag = F.lower(F.col("return_status").cast("string")).isin(lx.RETURNED_WORDS).cast("int")
    return distribution.correlation_matrix(complete.withColumn("returned", flag), ["final_amount", "rating", "returned"])


# --- brands and products ------------------------------------------------------------------------


def top_brands(df: DataFrame, catalog: DataFrame, count: int = 20) -> DataFrame:
    return top(revenue_by_attribute(df, catalog, "brand"), count, "revenue", "brand")


def brand_monthly(df: DataFrame, catalog: DataFrame, count: int = 5) -> DataFrame:
    """Monthly revenue of the strongest brands, 0 in months without sales of one of them."""
    cells = revenue_by_attribute(df, catalog, "brand", fn.year_month("order_date").alias("order_ym"))
    packed = cells.groupBy("brand").agg(
        F.sum("revenue").alias("total"), F.map_from_entries(F.collect_list(F.struct("order_ym", "revenue"))).alias("months"))
    strongest = top(packed, count, "total", "brand")
    # over `count` rows: every month in which any of them sold
    listed = F.array_distinct(F.flatten(F.collect_list(F.map_keys("months")).over(Window.partitionBy())))
    filled = strongest.select("brand", "months", listed.alias("all_months")).select("brand", "months", F.explode("all_months").alias("order_ym"))
    return filled.select("order_ym", "brand", F.coalesce(F.try_element_at("months", F.col("order_ym")), F.lit(0)).alias("revenue"))


def top_brand_rows(df: DataFrame, count: int = 5) -> DataFrame:
    """Transactions of the strongest brands; the key list is at most ``count`` rows."""
    totals = present(df, "brand").groupBy("brand").agg(revenue().alias("revenue"))
    return df.join(F.broadcast(top(totals, count, "revenue", "brand").select("brand")), "brand", "leftsemi")


def discount_rows(df: DataFrame) -> DataFrame:
    """Discount in percent of the list price, for rows where it is defined."""
    price = F.col("original_price_inr")
    number = fn.strip_numeric(price) if dict(df.dtypes)["original_price_inr"] == "string" else price
    percent = ratio(number - F.col("final_amount"), number) * 100
    return df.withColumn("disc_pct", percent).filter("disc_pct is not null")


def discount_trend(df: DataFrame, bins: int = 50) -> DataFrame:
    return distribution.binned_mean(discount_rows(df), "disc_pct", "final_amount", bins)


def rating_by_product(df: DataFrame) -> DataFrame:
    """Mean rating and revenue per product, over rated rows."""
    rated = present(df, "rating", "product_id").withColumn("rating", F.col("rating").try_cast("decimal(6,3)"))
    return rated.groupBy("product_id").agg(mean("rating").alias("avg_rating"), revenue().alias("revenue")).filter("avg_rating is not null")


def product_lifecycle(df: DataFrame) -> DataFrame:
    stats = present(df, "product_id").groupBy("product_id").agg(
        F.min("order_date").alias("first_sale"), F.max("order_date").alias("last_sale"),
        F.count("order_date").alias("sales_count"), revenue().alias("revenue"))
    return stats.withColumn("lifetime_days", F.extract(F.lit("DAY"), F.col("last_sale") - F.col("first_sale")).cast("int"))


def top_product_monthly(df: DataFrame, count: int = 10) -> DataFrame:
    totals = present(df, "product_id").groupBy("product_id").agg(revenue().alias("total"))
    strongest = top(totals, count, "total", "product_id").select("product_id")
    kept = present(df, "order_date").join(F.broadcast(strongest), "product_id", "leftsemi")
    return kept.groupBy("product_id", fn.year_month("order_date").alias("order_ym")).agg(revenue().alias("revenue"))


def brand_price_box(df: DataFrame, catalog: DataFrame, count: int = 8) -> DataFrame:
    """Price distribution over the orders of the strongest brands; empty for fewer than two brands."""
    totals = product_totals(df, catalog, ["brand", "price"])
    # one row per product, brand and price, looked at for the brands, the quantiles and the whiskers
    usable = staged(present(totals, "brand", "price").filter(F.trim("brand") != ""), "brand-prices")
    brands = usable.groupBy("brand").agg(F.sum("revenue").alias("total"))
    strongest = top(brands, count, "total", "brand").select("brand")
    kept = usable.join(F.broadcast(strongest), "brand", "leftsemi")
    return distribution.box_statistics(kept, "brand", "price", "orders").filter(scalar(brands, F.count(F.lit(1))) >= 2)


# --- business health ----------------------------------------------------------------------------


def kpis(df: DataFrame) -> DataFrame:
    """Total revenue, orders, customers, mean order value and the last year's growth."""
    years = yearly_revenue_growth(df)
    last = scalar(years, F.when(F.count(F.lit(1)) > 1, F.max_by("pct_growth", "year") / 100))
    totals = df.agg(
        revenue().cast("double").alias("total_revenue"), F.count(F.lit(1)).cast("double").alias("orders"),
        F.count_distinct("customer_id").cast("double").alias("customers"), mean().alias("avg_order_value"))
    return melt(totals.withColumn("yoy_last", last), [], [*totals.columns, "yoy_last"], "metric", "value")


def monthly_order_value(df: DataFrame) -> DataFrame:
    return present(df, "order_date").groupBy(fn.year_month("order_date").alias("order_ym")).agg(mean().alias("avg_order_value"))
