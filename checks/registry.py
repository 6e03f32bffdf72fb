"""One callable ``(spark, folder) -> DataFrame`` per operator and question."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind import functions as fn
from tradewind.operators import customers, distribution, duplicates, outliers, quality
from tradewind.operators.dictionary import learn, looked_up
from tradewind.plans import analysis, cleaning, dashboard, warehouse
from tradewind.schemas import warehouse_schema
from tradewind.session import scratch_path, staged
from tradewind.sources import bindings, readers, sinks
from tradewind.sources.resolve import align, canonical_frame

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ROW = ["transaction_id", "copy"]
PRODUCT_ROW = ["row_no", "copy"]
TIME_ORDER = ["order_date", "transaction_id"]


def portable(df: DataFrame) -> DataFrame:
    """Plain column types at the edge: exact decimals as DOUBLE, dates as ISO text, small integers as INT."""
    def edge(name: str, kind: str) -> Column:
        column = F.col(name)
        if kind.startswith("decimal"):
            return column.cast("double").alias(name)
        if kind == "date":
            return fn.iso_date(column).alias(name)
        if kind.startswith("timestamp"):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name)
        if kind in ("tinyint", "smallint"):
            return column.cast("int").alias(name)
        return column

    return df.select(*[edge(name, kind) for name, kind in df.dtypes])


def query(name: str):
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, folder: portable(build(spark, folder))
        return build
    return register


def over_transactions(key: str, plan: Callable[..., DataFrame], /, *columns: str, catalog: bool = False, **options) -> None:
    """Register a question that reads these transaction columns, and the catalog if it needs it."""
    def build(spark: SparkSession, folder: str) -> DataFrame:
        tables = [bindings.transactions(spark, folder, *columns)]
        if catalog:
            tables.append(bindings.products(spark, folder))
        return plan(*tables, **options)
    query(key)(build)


def cleaned_text(name: str, raw: str, function: Callable[[str], Column]) -> None:
    """Register a cleaning function over every row of an untidy transaction column."""
    query(name)(lambda spark, folder: bindings.raw_transactions(spark, folder, *ROW, raw).select(
        *ROW, F.col(raw).alias("raw"), function(raw).alias("clean")))


def cleaned_product(name: str, raw: str, function: Callable[[str], Column]) -> None:
    query(name)(lambda spark, folder: bindings.raw_products(spark, folder).select(
        *PRODUCT_ROW, F.col(raw).alias("raw"), function(raw).alias("clean")))


# --- sources and sinks ---------------------------------------------------------------------------


@query("canonical_transactions")
def _(spark, folder):
    return canonical_frame(bindings.transactions(spark, folder))


@query("scan_csv_strings")
def _(spark, folder):
    """Names with quotes, commas and line breaks survive the way through a file."""
    path = scratch_path(spark, "catalog-csv")
    odd = F.when(F.col("row_no") % 4 == 0, F.concat("item_name", F.lit('\n"second, line"'))).otherwise(F.col("item_name"))
    sinks.write_csv(bindings.raw_products(spark, folder).withColumn("item_name", odd), path)
    return readers.scan_text(spark, path, multiline=True)


@query("canonical_from_csv")
def _(spark, folder):
    """A file with headers of its own."""
    path = scratch_path(spark, "export-csv")
    rows = bindings.transactions(spark, folder, "transaction_id", "order_date", "final_amount", "customer_id", "product_id", "customer_state", "payment_method", "return_status")
    sinks.write_csv(rows.toDF("\ufeffTransaction ID", " Order Date ", "Final Amount", "CUSTOMER-ID", "product id", "Ship State", "Payment Method used", "Return/Status"), path)
    found = canonical_frame(readers.scan_text(spark, path), lenient=True)
    return found.select("transaction_id", "order_date", "order_year", "order_month", "final_amount", "customer_id", "product_id", "customer_state", "payment_method", "return_status", "rating")


@query("scan_cleaned")
def _(spark, folder):
    path = scratch_path(spark, "orders-csv")
    wanted = bindings.transactions(
        spark, folder, "transaction_id", "order_date", "customer_id", "product_id", "final_amount", "quantity", "is_festival_sale")
    sinks.write_csv(wanted, path)
    return readers.scan_typed(spark, path, wanted.schema)


@query("union_chunks")
def _(spark, folder):
    rows = bindings.transactions(spark, folder, "transaction_id", "order_year", "final_amount")
    return readers.union_chunks([rows.filter("order_year < 1998"), rows.filter("order_year >= 1998")])


over_transactions("sample_rows", lambda t: readers.first_rows(t, 100, *TIME_ORDER), "order_date", "transaction_id", "customer_id", "final_amount")
over_transactions("sample_by_hash", lambda t: readers.sample_by_hash(t, "transaction_id", 5000), "transaction_id", "discount_percent", "final_amount")


# --- projection, filters and data quality --------------------------------------------------------


@query("align_schema")
def _(spark, folder):
    return align(bindings.products(spark, folder), warehouse_schema("products"))


over_transactions("derive_date_parts", lambda t: t.select(
    "transaction_id", F.year("order_date").alias("order_year"), F.month("order_date").alias("order_month"),
    fn.year_month("order_date").alias("order_ym")), "transaction_id", "order_date")
over_transactions("filter_year_month", dashboard.in_period, "transaction_id", "order_year", "order_month", "final_amount", year=1998, month=10)
over_transactions("top_brand_semi_join", analysis.top_brand_rows, "transaction_id", "brand", "final_amount")


@query("dq_pk_violations")
def _(spark, folder):
    return quality.key_violations(bindings.raw_transactions(spark, folder, "transaction_id"), "transactions", "transaction_id").unionByName(
        quality.key_violations(bindings.raw_products(spark, folder).select(fn.clean_product_id("sku").alias("sku")), "products", "sku"))


@query("dq_missing_values")
def _(spark, folder):
    return quality.missing_values(bindings.raw_transactions(spark, folder), "transactions", ["customer_city", "is_prime_member", "original_price_inr"])


@query("dq_orphans")
def _(spark, folder):
    fact = bindings.transactions(spark, folder, "product_id").select(F.concat(F.lit("P"), "product_id").alias("product_id"))
    catalog = cleaning.clean_products(bindings.raw_products(spark, folder), PRODUCT_ROW).table
    return quality.orphans(fact, catalog, "product_id")


@query("conform_decimals")
def _(spark, folder):
    rows = bindings.raw_transactions(spark, folder, *ROW, "final_amount", "quantity")
    return rows.select(*ROW, fn.to_decimal("final_amount", 12, 2).alias("final_amount"), fn.to_decimal("quantity", 3, 1).alias("quantity"))


@query("conform_rejects")
def _(spark, folder):
    rows = bindings.raw_transactions(spark, folder, "final_amount", "customer_rating")
    return quality.conform_rejects(rows, {"final_amount": "decimal(12,2)", "customer_rating": "decimal(3,1)"})


# --- cleaning functions --------------------------------------------------------------------------

cleaned_text("clean_date", "order_date", fn.clean_date)
cleaned_text("clean_price", "original_price_inr", fn.clean_price)
cleaned_text("clean_rating", "customer_rating", fn.clean_rating)
cleaned_text("clean_city", "customer_city", fn.clean_city)
cleaned_text("clean_bool", "is_prime_member", fn.clean_bool)
cleaned_text("clean_delivery_days", "delivery_days", fn.clean_delivery_days)
cleaned_text("clean_payment", "payment_method", fn.clean_payment)
cleaned_text("strip_numeric", "original_price_inr", fn.strip_numeric)
cleaned_text("coerce_ints", "final_amount", fn.coerce_int)
cleaned_text("flag_from_text", "is_prime_member", fn.flag_from_text)
cleaned_text("lenient_flag", "is_prime_member", fn.lenient_flag)
cleaned_product("clean_product_name", "item_name", fn.clean_product_name)
cleaned_product("clean_brand", "brand_name", fn.clean_brand)
cleaned_product("clean_category", "category", fn.clean_category)
cleaned_product("title_case", "brand_name", fn.title_case)
cleaned_product("null_tokens", "mrp", fn.null_tokens)
cleaned_product("blank_to_null", "image_url", fn.blank_to_null)


@query("clean_product_id")
def _(spark, folder):
    return cleaning.with_product_ids(bindings.raw_products(spark, folder), PRODUCT_ROW).select("product_id", *PRODUCT_ROW)


@query("surrogate_ids")
def _(spark, folder):
    return cleaning.with_product_ids(bindings.raw_products(spark, folder).drop("sku"), PRODUCT_ROW).select("product_id", *PRODUCT_ROW)


over_transactions("format_currency", lambda t: dashboard.monthly_revenue(t).select(
    "order_ym", fn.format_currency(F.col("revenue").cast("double")).alias("shown")), "order_year", "order_month", "final_amount")

REJECTS = {"rejects_dates": "order_date", "rejects_price": "original_price_inr", "rejects_city": "customer_city", "rejects_bool": "is_prime_member"}
for _name, _raw in REJECTS.items():
    query(_name)(lambda spark, folder, raw=_raw: cleaning.transaction_rejects(bindings.raw_transactions(spark, folder, raw)))


@query("rejects_all")
def _(spark, folder):
    return cleaning.transaction_rejects(bindings.raw_transactions(spark, folder))


@query("map_payment_pairs")
def _(spark, folder):
    return quality.mapping_pairs(bindings.raw_transactions(spark, folder, "payment_method"), "payment_method", fn.clean_payment("payment_method"))


# --- duplicates, outliers and whole pipelines ----------------------------------------------------

DUPLICATE_COLUMNS = [*ROW, "customer_id", "product_id", "order_date", "final_amount", "quantity"]
KEY = ["customer_id", "product_id", "order_date", "final_amount"]


def _valued(spark, folder, *columns):
    return cleaning.clean_values(bindings.raw_transactions(spark, folder, *columns))


@query("dup_groups")
def _(spark, folder):
    return duplicates.key_groups(_valued(spark, folder, *DUPLICATE_COLUMNS), KEY, "quantity", ROW).select(*KEY, "rows", "quantity")


@query("dup_erroneous")
def _(spark, folder):
    return duplicates.duplicate_rows(_valued(spark, folder, *DUPLICATE_COLUMNS), KEY, "quantity", ROW)


@query("dedupe_transactions")
def _(spark, folder):
    return duplicates.dedupe(_valued(spark, folder, *DUPLICATE_COLUMNS), KEY, "quantity", ROW)


def _repaired(spark, folder):
    rows = _valued(spark, folder, *ROW, "product_id", "final_amount")
    repaired = outliers.repair_amounts(rows, "final_amount", "product_id", ROW)
    return repaired.withColumn("ref_median", F.round("ref_median", 4))


@query("price_outliers_fixed")
def _(spark, folder):
    return _repaired(spark, folder).filter("repair is not null and repair <> 'flag'")


@query("price_outliers_flagged")
def _(spark, folder):
    return _repaired(spark, folder).filter("repair = 'flag'").drop("amount_before")


@query("dedupe_products")
def _(spark, folder):
    values = cleaning.product_values(bindings.raw_products(spark, folder), PRODUCT_ROW)
    return duplicates.keep_most_complete(values, "product_id", PRODUCT_ROW).select("product_id", *PRODUCT_ROW, "brand")


@query("product_price_flags")
def _(spark, folder):
    catalog = cleaning.product_values(bindings.raw_products(spark, folder), PRODUCT_ROW)
    return outliers.catalog_price_flags(catalog).select("product_id", *PRODUCT_ROW, "price")


@query("clean_transactions")
def _(spark, folder):
    return cleaning.clean_transactions(bindings.raw_transactions(spark, folder), ROW).table


@query("clean_products")
def _(spark, folder):
    return cleaning.clean_products(bindings.raw_products(spark, folder), PRODUCT_ROW).table


@query("cleaning_summary")
def _(spark, folder):
    return cleaning.cleaning_summary(
        bindings.raw_transactions(spark, folder), bindings.raw_products(spark, folder), ROW, PRODUCT_ROW)


# --- star schema ---------------------------------------------------------------------------------


over_transactions("dim_customers", lambda t: warehouse.customers(t, TIME_ORDER), "transaction_id", "order_date", "customer_id",
                  "customer_city", "customer_state", "customer_tier", "customer_age_group", "is_prime_member", "final_amount")
over_transactions("dim_time", warehouse.calendar, "order_date")
over_transactions("fact_transactions", warehouse.fact)


@query("dim_products")
def _(spark, folder):
    return warehouse.products(cleaning.clean_products(bindings.raw_products(spark, folder), PRODUCT_ROW).table)


def _warehouse(spark, folder):
    return warehouse.build(bindings.transactions(spark, folder), bindings.products(spark, folder), TIME_ORDER, ["product_id"])


@query("warehouse_rejects")
def _(spark, folder):
    """Untidy order lines and an untidy catalog straight into the load."""
    raw = staged(bindings.raw_transactions(spark, folder, *ROW, "order_date", "customer_id", "product_id", "final_amount", "quantity", "delivery_days", "customer_rating"))
    dated = looked_up(raw, learn(raw, {"order_date": ("order_date", fn.clean_date)}))
    odd = dated.withColumns({
        "order_date": F.col("order_date").cast("timestamp_ntz"),
        "final_amount": F.when(F.col("quantity") == "7", F.lit("99999999999.5")).otherwise(F.col("final_amount")),
        "product_id": F.when(F.col("quantity") == "9", F.lit("unknown")).otherwise(F.col("product_id")),
    })
    catalog = bindings.raw_products(spark, folder).select(F.regexp_extract("sku", r"(\d+)", 1).alias("product_id"), "rating", *PRODUCT_ROW)
    return warehouse.rejects(warehouse.build(odd, catalog, ROW, PRODUCT_ROW))


@query("warehouse_row_counts")
def _(spark, folder):
    return warehouse.row_counts(_warehouse(spark, folder))


@query("warehouse_checks")
def _(spark, folder):
    transactions, catalog = bindings.transactions(spark, folder), bindings.products(spark, folder)
    return warehouse.checks({
        "products": warehouse.products(catalog), "customers": warehouse.customers(transactions, TIME_ORDER),
        "transactions": warehouse.fact(transactions), "time_dimension": warehouse.calendar(transactions)})


@query("warehouse_load")
def _(spark, folder):
    return warehouse.row_counts(warehouse.load(spark, _warehouse(spark, folder), scratch_path(spark, "warehouse")))


# --- joins ---------------------------------------------------------------------------------------

for _attribute in ("category", "brand"):
    over_transactions(f"enrich_{_attribute}", lambda t, c, name=_attribute: analysis.enrich(t, c, name),
                      "transaction_id", "product_id", "final_amount", catalog=True)
over_transactions("avg_price_joinback", analysis.with_product_mean, "transaction_id", "product_id", "final_amount")

# --- questions -----------------------------------------------------------------------------------

over_transactions("yearly_revenue_growth", analysis.yearly_revenue_growth, "order_year", "final_amount")
over_transactions("trend_yearly", analysis.yearly_trend, "order_year", "final_amount")
over_transactions("top_growth_years", analysis.top_growth_years, "order_year", "final_amount")
over_transactions("pivot_year_month", analysis.year_month_matrix, "order_year", "order_month", "final_amount")
over_transactions("monthly_totals", analysis.monthly_totals, "order_month", "final_amount")
over_transactions("category_seasonality", analysis.category_seasonality, "product_id", "order_year", "order_month", "final_amount", catalog=True)
over_transactions("rfm", customers.rfm, "customer_id", "order_date", "final_amount")
over_transactions("rfm_zscores", lambda t: customers.scaled_points(customers.rfm(t)), "customer_id", "order_date", "final_amount")
over_transactions("rfm_segments", lambda t: customers.segment(customers.rfm(t)), "customer_id", "order_date", "final_amount")
over_transactions("rfm_segment_summary", lambda t: customers.segment_summary(customers.segment(customers.rfm(t))), "customer_id", "order_date", "final_amount")
over_transactions("rfm_recency_quartile", lambda t: customers.recency_quartile(customers.rfm(t)), "customer_id", "order_date", "final_amount")
over_transactions("payment_monthly_counts", analysis.payment_monthly_counts, "order_date", "payment_method")
over_transactions("payment_monthly_share", analysis.payment_monthly_share, "order_date", "payment_method")
over_transactions("category_revenue", analysis.category_revenue, "product_id", "final_amount", catalog=True)
over_transactions("category_share_top10", analysis.category_share, "product_id", "final_amount", catalog=True)
over_transactions("prime_aov", analysis.prime_order_value, "is_prime_member", "final_amount")
over_transactions("prime_frequency", analysis.prime_frequency, "customer_id", "is_prime_member")
over_transactions("prime_category", analysis.prime_category, "product_id", "is_prime_member", "final_amount", catalog=True)
over_transactions("state_revenue", analysis.place_revenue, "customer_state", "final_amount", place="customer_state")
over_transactions("city_revenue", analysis.place_revenue, "customer_city", "final_amount", place="customer_city")
over_transactions("festival_windows", analysis.festival_windows, "order_date", "order_year", "final_amount")
over_transactions("unpivot_festival", analysis.festival_long, "order_date", "order_year", "final_amount")
over_transactions("age_spending", analysis.age_spending, "customer_age", "final_amount")
over_transactions("price_demand", analysis.price_demand, "transaction_id", "product_id", "final_amount", catalog=True)
over_transactions("corr_price_demand", analysis.price_demand_correlation, "transaction_id", "product_id", "final_amount", catalog=True)
over_transactions("hist_delivery", distribution.histogram, "delivery_days", value="delivery_days", bins=40)
over_transactions("delivery_on_time", analysis.delivery_on_time, "delivery_days")
over_transactions("returns_summary", analysis.returns_summary, "return_status", "final_amount")
over_transactions("corr_return_rating", analysis.return_rating_correlation, "return_status", "rating", "final_amount")
over_transactions("brand_top20", analysis.top_brands, "product_id", "final_amount", catalog=True)
over_transactions("brand_monthly_top5", analysis.brand_monthly, "product_id", "order_date", "final_amount", catalog=True)
over_transactions("cohort_counts", customers.cohort_counts, "customer_id", "order_date")
over_transactions("cohort_retention", customers.cohort_retention, "customer_id", "order_date")
over_transactions("cohort_clv", customers.cohort_value, "customer_id", "order_date", "final_amount")
over_transactions("discount_full", analysis.discount_rows, "transaction_id", "original_price_inr", "final_amount")
over_transactions("discount_trend", analysis.discount_trend, "original_price_inr", "final_amount")
over_transactions("hist_rating", distribution.histogram, "rating", value="rating", bins=20)
over_transactions("rating_by_product", analysis.rating_by_product, "product_id", "rating", "final_amount")


def _journeys(transactions, catalog):
    named = analysis.enrich(transactions, catalog, "category")
    return customers.transitions(named, "category", "transaction_id")


@query("category_transitions_timed")
def _(spark, folder):
    """Which kind of event follows which, per user, by the time of day."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    steps = events.select(F.col("user_id").cast("string").alias("customer_id"), F.col("ts").alias("order_date"), F.format_string("event-%012d", "event_id").alias("event"), "event_type")
    return customers.transitions(steps, "event_type", "event")


over_transactions("category_transitions", _journeys, "transaction_id", "customer_id", "product_id", "order_date", catalog=True)
over_transactions("product_lifecycle", analysis.product_lifecycle, "product_id", "order_date", "final_amount")
over_transactions("top_product_monthly", analysis.top_product_monthly, "product_id", "order_date", "final_amount")
over_transactions("brand_price_box", analysis.brand_price_box, "product_id", "final_amount", catalog=True)
over_transactions("kpis", analysis.kpis, "order_year", "customer_id", "final_amount")
over_transactions("annual_revenue", analysis.annual_revenue, "order_year", "final_amount")
over_transactions("monthly_aov", analysis.monthly_order_value, "order_date", "final_amount")
over_transactions("top10_categories", analysis.category_revenue, "product_id", "final_amount", catalog=True, count=10)

# --- dashboard -----------------------------------------------------------------------------------

over_transactions("executive_summary", dashboard.executive_summary, "order_year", "order_month", "customer_id", "category", "final_amount", year=1998)
over_transactions("executive_summary_all", dashboard.executive_summary, "order_year", "order_month", "customer_id", "category", "final_amount")
over_transactions("top_category", dashboard.top_category, "category", "final_amount")
over_transactions("month_monitor", dashboard.month_monitor, "order_date", "customer_id", "final_amount")
over_transactions("target_alert", dashboard.target_alert, "order_date", "customer_id", "final_amount", target=5_000_000)
over_transactions("category_share_top6", dashboard.category_share, "category", "final_amount")
over_transactions("top_states_by_rows", lambda t: dashboard.top_states(canonical_frame(t)), "transaction_id", "order_date", "customer_state")


@query("festival_monthly_by_name")
def _(spark, folder):
    rows = bindings.transactions(spark, folder, "order_date", "final_amount").withColumn("festival_name", F.expr("case month(order_date) when 10 then 'Diwali' when 3 then 'Holi' end"))
    return dashboard.festival_monthly(canonical_frame(rows))


@query("price_demand_no_catalog_price")
def _(spark, folder):
    catalog = warehouse.products(bindings.products(spark, folder).drop("price"))
    return analysis.price_demand(canonical_frame(bindings.transactions(spark, folder, "transaction_id", "order_date", "product_id", "final_amount")), catalog)


over_transactions("top_states", dashboard.top_states, "customer_state", "final_amount")
over_transactions("monthly_revenue", dashboard.monthly_revenue, "order_year", "order_month", "final_amount")
over_transactions("ols_discount", dashboard.discount_line, "discount_percent", "final_amount")
over_transactions("customers_by_year", dashboard.customers_by_year, "order_year", "customer_id")
over_transactions("revenue_series", dashboard.revenue_series, "order_year", "order_month", "final_amount")
over_transactions("category_performance", dashboard.category_performance, "category", "order_date", "final_amount")
over_transactions("festival_monthly", dashboard.festival_monthly, "is_festival_sale", "order_year", "order_month", "final_amount")
over_transactions("price_optimization", dashboard.price_optimization, "product_id", "original_price_inr", "order_date", "final_amount")
over_transactions("describe_rfm", lambda t: dashboard.describe_customers(customers.rfm(t)), "customer_id", "order_date", "final_amount")
over_transactions("age_group_spending", dashboard.age_group_spending, "customer_age_group", "final_amount")
over_transactions("top_products", dashboard.top_products, "product_id", "order_date", "final_amount")
over_transactions("describe_rating", dashboard.describe_rating, "rating")
over_transactions("payment_counts", dashboard.value_counts, "payment_method", name="payment_method", alias="method", count=20)
over_transactions("return_counts", dashboard.value_counts, "return_status", name="return_status", alias="status")
