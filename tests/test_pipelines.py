"""Column resolution, sources and sinks, pipelines, star schema and whole runs."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tradewind.functions import parsing
from tradewind.operators.duplicates import keep_most_complete
from tradewind.plans import analysis, cleaning, dashboard, jobs, warehouse
from tradewind.schemas import warehouse_schema, warehouse_tables
from tradewind.session import scratch_path
from tradewind.sources import bindings, readers, resolve, sinks
from tradewind.streaming import monitor


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- columns --------------------------------------------------------------------------------------


def test_find_column():
    find = resolve.find_column
    assert find(["Order Date", "Amount"], ["order_date"]) == "Order Date"
    assert find(["orderdate"], ["order_date"]) == "orderdate"
    assert find(["customer_state_name"], ["state"]) == "customer_state_name"
    assert find(["average_price", "customer_age_group"], ["age"]) is None
    assert find(["method of payment"], ["payment_method"]) == "method of payment"
    assert find(["b", "a"], ["a", "b"]) == "a" and find([], ["a"]) is None
    assert resolve.pick_first(["price", "mrp"], ["mrp", "price"]) == "mrp"


def test_canonical_frame_fills_and_derives(spark):
    frame = spark.createDataFrame([("2020-03-04 05:06:07", "₹1,200.50", "c1")], "purchase_date string, final_amount_inr string, customer_id string")
    row = resolve.canonical_frame(frame).collect()[0]
    assert (row.order_date, row.order_year, row.order_month) == (dt.datetime(2020, 3, 4, 5, 6, 7), 2020, 3)
    assert float(row.final_amount) == 1200.5 and row.customer_id == "c1" and row.category is None
    with pytest.raises(ValueError):
        resolve.canonical_frame(frame.drop("purchase_date"))


def test_align_nulls_what_does_not_fit(spark):
    frame = spark.createDataFrame([("p", "12.345", "x", 1)], "product_id string, price string, launch_year string, extra int")
    row = resolve.align(frame, warehouse_schema("products")).collect()[0]
    assert (str(row.price), row.launch_year, row.brand) == ("12.35", None, None) and not hasattr(row, "extra")


# --- sources and sinks ----------------------------------------------------------------------------


def test_text_scan_keeps_order_and_nulls(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Order Date,Name\n" + "".join(f"d{i},\"a \"\"{i}\"\", x\"\n" for i in range(50)) + "NA,nan\n", encoding="utf8")
    frame = resolve.with_snake_headers(readers.scan_text(spark, str(path), sequence=True))
    found = frame.orderBy(readers.SEQUENCE).collect()
    assert [r.order_date for r in found] == [f"d{i}" for i in range(50)] + [None]
    assert found[3].name == 'a "3", x' and found[-1].name is None


def test_missing_input(spark, tmp_path):
    assert readers.try_scan(readers.scan_text, spark, str(tmp_path / "none.csv"), required=False) is None
    with pytest.raises(FileNotFoundError):
        readers.try_scan(readers.scan_text, spark, str(tmp_path / "none.csv"))


def test_tables_in_the_catalog(spark):
    for table in warehouse_tables():
        sinks.create_table(spark, table, f"w_{table}", scratch_path(spark, table))
        assert set(readers.table_columns(spark, f"w_{table}")) == set(warehouse_schema(table).names)
        spark.sql(f"DROP TABLE w_{table}")


def test_samples_are_repeatable(spark):
    frame = spark.range(1000).withColumn("k", F.col("id").cast("string"))
    once = rows(readers.sample_by_hash(frame, "k", 10))
    assert once == rows(readers.sample_by_hash(frame.repartition(7), "k", 10)) and len(once) == 10


# --- cleaning -------------------------------------------------------------------------------------


def test_festival_name_stays_text_and_rejects_are_complete(spark):
    raw = spark.createDataFrame(
        [(1, "2020-01-01", "Diwali", "Yes", "20", "60"), (2, "garbage", None, "maybe", "express", "1")],
        "id int, `Order Date` string, festival_name string, is_festival_sale string, delivery_days string, final_amount string")
    done = cleaning.clean_transactions(raw, ["id"])
    first, second = done.table.orderBy("id").collect()
    assert (first.festival_name, first.is_festival_sale, first.order_date) == ("Diwali", True, dt.date(2020, 1, 1))
    assert (second.is_festival_sale, second.delivery_days) == (False, None)
    assert {(r.rule, r.raw) for r in done.rejects.collect()} == {("order_date", "garbage"), ("is_festival_sale", "maybe"), ("delivery_days", "express")}


def test_every_raw_value_is_cleaned_or_rejected(spark, sf_dir):
    raw = bindings.raw_transactions(spark, sf_dir, "transaction_id", "copy", "order_date")
    clean = cleaning.clean_values(raw)
    lost = cleaning.transaction_rejects(raw).agg(F.sum("rows")).collect()[0][0]
    assert clean.filter("order_date is not null").count() + lost == raw.count()


def test_missing_product_ids_are_numbered(spark):
    raw = spark.createDataFrame([(1, " a "), (2, None), (3, ""), (4, "A"), (5, "  ")], "i int, sku string")
    assert [r.product_id for r in cleaning.with_product_ids(raw, ["i"]).orderBy("i").collect()] == ["A", "MISSING_1", "MISSING_2", "A", "MISSING_3"]
    assert [r.product_id for r in cleaning.with_product_ids(raw.drop("sku"), ["i"]).orderBy("i").collect()] == [f"PID_{i}" for i in range(1, 6)]


def test_row_order_does_not_matter(spark, sf_dir):
    raw, order = bindings.raw_transactions(spark, sf_dir), ["transaction_id", "copy"]
    assert rows(cleaning.clean_transactions(raw, order).table, *order) == rows(cleaning.clean_transactions(raw.repartition(5), order).table, *order)


# --- star schema ----------------------------------------------------------------------------------


def test_calendar(spark):
    frame = spark.createDataFrame([("2024-01-30 00:00:00",), ("2024-02-01 08:00:00",), (None,)], "d string").select(F.col("d").cast("timestamp_ntz").alias("order_date"))
    found = warehouse.calendar(frame).orderBy("date_id").collect()
    assert [str(r.date_id) for r in found] == ["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02"]
    day = lambda text: warehouse.calendar(spark.createDataFrame([(text,)], "d string").select(F.col("d").cast("timestamp_ntz").alias("order_date"))).collect()[0]
    assert (day("2021-01-03").week_of_year, day("2021-01-03").day_name, day("2021-01-03").is_weekend) == (53, "Sunday", True)
    assert day("2024-01-06").day_name == "Saturday" and day("2024-01-06").is_weekend
    assert warehouse.calendar(frame.filter("order_date is null")).count() == 0


def test_customers_without_amounts_or_attributes(spark):
    frame = spark.createDataFrame([("c1", "t1"), ("c1", "t2"), (None, "t3")], "customer_id string, transaction_id string")
    found = warehouse.customers(frame, ["transaction_id"]).collect()
    assert len(found) == 1 and found[0].total_orders == 2 and found[0].lifetime_value is None and found[0].avg_order_value is None


def test_first_attributes_win(spark):
    frame = spark.createDataFrame([("c", 2, "Delhi", "10"), ("c", 1, "Pune", "5.555")], "customer_id string, i int, customer_city string, final_amount string")
    row = warehouse.customers(frame, ["i"]).collect()[0]
    assert (row.customer_city, str(row.lifetime_value), str(row.avg_order_value)) == ("Pune", "15.56", "7.78")


def test_warehouse_checks(spark):
    facts = spark.createDataFrame([("t1", "2020-01-01", "c1", "p1"), ("t2", "2020-01-02", None, "p1"), ("t3", "2020-01-03", "c1", "p9")],
                                  "transaction_id string, order_date string, customer_id string, product_id string")
    tables = warehouse.build(facts.withColumn("order_date", F.col("order_date").cast("timestamp_ntz")), spark.createDataFrame([("p1",)], "product_id string"), ["transaction_id"])
    assert sorted((r.transaction_id, r.problems[0].rule, r.problems[0].raw) for r in tables["rejected_transactions"].collect()) == [("t2", "missing", None), ("t3", "orphan", "p9")]
    loaded = warehouse.load(spark, tables, scratch_path(spark, "test-warehouse"))
    assert rows(warehouse.checks(loaded)) == []
    assert dict(rows(warehouse.row_counts(loaded))) == {"customers": 1, "products": 1, "transactions": 1, "time_dimension": 1}
    pruned = plan_of(loaded["transactions"].filter("order_year = 2020").select("transaction_id"))
    assert "PartitionFilters: [isnotnull(order_year" in pruned


def test_every_row_is_loaded_or_rejected(spark):
    facts = spark.createDataFrame([
        ("t1", "2020-01-01", "c1", "p1", "99999999999.5", "3", "4.5", 0), ("t2", "2020-01-01", "c1", "p1", "10", "500", "abc", 1), ("t3", "2020-01-01", "c1", "p1", "10", " ", None, 2),
        ("t3", "2020-01-02", "c1", "p1", "11", "3", "4", 3), (None, "2020-01-02", "c1", "p1", "11", "3", "4", 4), ("t4", "2020-01-02", "c2", "p2", "11", "3", "4", 5), ("t5", "2020-01-02", "c2", None, "11", "3", "4", 6)],
        "transaction_id string, order_date string, customer_id string, product_id string, final_amount string, delivery_days string, customer_rating string, i int")
    catalog = spark.createDataFrame([("p1", "4", 0), ("p1", "5", 1), ("p2", "bad", 2), (None, "1", 3)], "product_id string, rating string, i int")
    tables = warehouse.build(facts, catalog, ["i"], ["i"])
    assert tables["transactions"].count() + tables["rejected_transactions"].count() == facts.count()
    assert tables["products"].count() + tables["rejected_products"].count() == catalog.count()
    found = {(r.table_name, r.rule, r.column_name, r.raw): r.rows for r in warehouse.rejects(tables).collect()}
    assert found == {
        ("transactions", "misfit", "final_amount", "99999999999.5"): 1, ("transactions", "misfit", "delivery_days", "500"): 1, ("transactions", "misfit", "customer_rating", "abc"): 1,
        ("transactions", "repeated", "transaction_id", "t3"): 1, ("transactions", "missing", "transaction_id", None): 1, ("transactions", "missing", "product_id", None): 1,
        ("transactions", "orphan", "product_id", "p2"): 1, ("products", "repeated", "product_id", "p1"): 1, ("products", "misfit", "rating", "bad"): 1, ("products", "missing", "product_id", None): 1}


# --- questions ------------------------------------------------------------------------------------


def sales(spark, data, columns):
    frame = spark.createDataFrame(data, columns)
    return frame.withColumn("order_date", F.col("order_date").cast("timestamp_ntz")).withColumn("order_year", F.year("order_date")).withColumn("order_month", F.month("order_date"))


def test_festival_windows_close_at_midnight(spark):
    days = ["2020-10-10", "2020-10-11", "2020-10-24 23:00:00", "2020-10-25", "2020-11-01", "2020-11-01 10:00:00", "2020-11-24", "2020-11-24 01:00:00", "2019-01-01"]
    df = sales(spark, [(d, 2.0 ** i) for i, d in enumerate(days)], "order_date string, final_amount double")
    assert rows(analysis.festival_windows(df)) == [("Diwali", 2019, 0.0, 0.0, 0.0), ("Diwali", 2020, 2.0 + 4.0, 8.0 + 16.0, 32.0 + 64.0)]


def test_own_festival_calendar_may_cross_years(spark):
    df = sales(spark, [("2020-12-30", 1.0), ("2021-01-01", 2.0), ("2021-01-05", 4.0)], "order_date string, final_amount double")
    calendar = spark.sql("select 'New Year' festival, 2021 year, date'2021-01-01' anchor, 5 days_before, 1 days_during, 9 days_after")
    assert rows(analysis.festival_windows(df, calendar)) == [("New Year", 2021, 1.0, 2.0, 4.0)]


def test_growth_from_nothing_is_null(spark):
    df = sales(spark, [("2018-01-01", 0.0), ("2019-01-01", 5.0), ("2020-01-01", 10.0)], "order_date string, final_amount double")
    assert rows(analysis.yearly_revenue_growth(df)) == [(2018, 0.0, 0.0), (2019, 5.0, None), (2020, 10.0, 100.0)]


def test_catalog_value_before_own_value(spark):
    df = spark.createDataFrame([("t1", "p1", "own", 1.0), ("t2", "p2", "own", 2.0), ("t3", "p3", None, 4.0)], "transaction_id string, product_id string, category string, final_amount double")
    catalog = spark.createDataFrame([("p1", "cat"), ("p1", None), ("p2", None)], "product_id string, category string")
    assert rows(analysis.category_revenue(df, catalog)) == [("cat", 1.0), ("own", 2.0)]
    assert rows(analysis.enrich(df, catalog, "category").select("transaction_id", "category")) == [("t1", "cat"), ("t2", "own"), ("t3", None)]


def test_discount_of_a_zero_price_is_dropped(spark):
    df = spark.createDataFrame([("100", 80.0), ("0", 5.0), ("₹200", 200.0)], "original_price_inr string, final_amount double")
    assert sorted(r.disc_pct for r in analysis.discount_rows(df).collect()) == [0.0, 20.0]


def test_festival_flag_must_be_true(spark):
    df = sales(spark, [("2020-10-01", 1.0, True), ("2020-10-02", 2.0, False), ("2020-10-03", 4.0, None)], "order_date string, final_amount double, is_festival_sale boolean")
    assert [r.revenue for r in dashboard.festival_monthly(df).collect()] == [1.0]


def test_growth_compares_the_same_month(spark):
    df = sales(spark, [("2019-05-01", 10.0, "c"), ("2019-06-01", 90.0, "c"), ("2020-05-01", 15.0, "d")], "order_date string, final_amount double, customer_id string").withColumn("category", F.lit("x"))
    shown = {r.metric: r.shown for r in dashboard.executive_summary(df, 2020, 5).collect()}
    assert shown["growth"] == "50.0%" and shown["total_revenue"] == "₹15" and shown["top_category"] == "x"
    assert {r.metric: r.shown for r in dashboard.executive_summary(df).collect()}["growth"] == "N/A"


def test_empty_age_buckets_are_kept(spark):
    df = spark.createDataFrame([("18", 1.0), ("0", 2.0), ("x", 4.0)], "customer_age string, final_amount double")
    got = {r.age_bucket: (r.total, r.orders, r.avg_amount) for r in analysis.age_spending(df).collect()}
    assert got["<18"] == (1.0, 1, 1.0) and got["65+"] == (0.0, 0, None) and len(got) == 7


def test_fewer_than_two_brands_give_no_boxes(spark):
    df = spark.createDataFrame([("p1", 1.0)], "product_id string, final_amount double")
    catalog = spark.createDataFrame([("p1", "b", 2.0)], "product_id string, brand string, price double")
    assert analysis.brand_price_box(df, catalog).count() == 0


def test_states_by_rows_without_amounts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "customer_state string")
    assert [tuple(r) for r in dashboard.top_states(df).collect()] == [("b", 2), ("a", 1)]


def test_shares_add_up(spark, sf_dir):
    df = bindings.transactions(spark, sf_dir, "order_date", "payment_method")
    sums = analysis.payment_monthly_share(df).groupBy("order_ym").agg(F.sum("share").alias("s")).collect()
    assert all(r.s == pytest.approx(1) for r in sums)


# --- plans ----------------------------------------------------------------------------------------


def test_plans_prune_and_limit_early(spark, sf_dir):
    growth = plan_of(analysis.yearly_revenue_growth(bindings.transactions(spark, sf_dir, "order_year", "final_amount")))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in growth and "p_partkey" not in growth
    assert "TakeOrderedAndProject" in plan_of(dashboard.top_products(bindings.transactions(spark, sf_dir, "product_id", "order_date", "final_amount")))
    best = keep_most_complete(spark.range(10).withColumn("k", F.col("id") % 2).withColumn("v", F.lit(None).cast("int")), "k", ["id"])
    assert "WindowGroupLimit" in plan_of(best)


def test_the_newest_month_reads_one_year(spark, sf_dir, tmp_path):
    sinks.write_table(bindings.transactions(spark, sf_dir, "order_date", "order_year", "customer_id", "final_amount"), str(tmp_path / "facts"), "order_year")
    facts = spark.read.parquet(str(tmp_path / "facts"))
    assert facts.select("order_year").distinct().count() > 5
    found = dashboard.month_monitor(facts, year="order_year")
    assert rows(found) == rows(dashboard.month_monitor(facts))
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", found._jdf.queryExecution().executedPlan().toString())
    assert any("order_year" in s and "subquery" in s.lower() for s in scans), scans


# --- whole runs -----------------------------------------------------------------------------------


def test_clean_and_load_run(spark, sf_dir, tmp_path):
    sinks.write_csv(bindings.raw_transactions(spark, sf_dir).withColumn("product_id", F.concat(F.lit("P"), "product_id")), str(tmp_path / "t"))
    sinks.write_csv(bindings.raw_products(spark, sf_dir), str(tmp_path / "p"))
    jobs.clean(spark, str(tmp_path / "t"), str(tmp_path / "p"), str(tmp_path / "cleaned"))
    assert jobs.load(spark, str(tmp_path / "cleaned"), str(tmp_path / "dw"), ["_seq"], ["_seq"]).count() == 0
    # copies of bulk orders share their id, and products without an id are unknown to the facts
    tables = warehouse.loaded(spark, str(tmp_path / "dw"))
    refused = tables["rejected_transactions"]
    assert "orphan" in {r.rule for r in refused.select(F.explode("problems").alias("p")).select("p.rule").distinct().collect()}
    assert tables["transactions"].count() + refused.count() == spark.read.parquet(str(tmp_path / "cleaned/transactions")).count()
    summary = {r.metric: r.value for r in spark.read.parquet(str(tmp_path / "cleaned/summary")).collect()}
    texts = spark.read.option("header", True).csv(str(tmp_path / "cleaned/rejected-texts/transactions"))
    assert summary["transactions"] > 0 and summary["review/transactions-rating_pairs"] > 0 and summary["review/transactions-payment_pairs"] > 0
    assert texts.count() == summary["rejects/transactions"] == sum(v for k, v in summary.items() if k.startswith("rejects/transactions/"))


def test_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "f.csv").write_text('\ufefforder_date,name\n2020-01-01,"a ""q"", b"\n2020-01-02,"two\nlines"\n2020-01-03,c\n')
    path = str(tmp_path / "f.csv")
    assert [tuple(r) for r in readers.scan_text(spark, path).orderBy("order_date").collect()] == [("2020-01-01", 'a "q", b'), ("2020-01-03", "c")]
    assert sum(r.rows for r in readers.broken_records(spark, path).collect()) >= 1
    assert [tuple(r) for r in readers.scan_text(spark, path, multiline=True).orderBy("order_date").collect()] == [("2020-01-01", 'a "q", b'), ("2020-01-02", "two\nlines"), ("2020-01-03", "c")]
    assert readers.broken_records(spark, path, multiline=True).count() == 0


def test_folder_of_files_with_different_headers(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,x\na,b\n")
    (tmp_path / "2.csv").write_text("b,a\ny,2\n")
    (tmp_path / "3.csv").write_text("c,a\n\nz,3\n")
    (tmp_path / "4.csv").write_text("")
    for multiline in (False, True):
        found = readers.scan_text(spark, str(tmp_path), multiline=multiline)
        assert found.columns == ["a", "b", "c"]
        assert sorted(map(str, rows(found))) == sorted(map(str, [("1", "x", None), ("a", "b", None), ("2", "y", None), ("3", None, "z")]))


@pytest.mark.parametrize("seed", [1, 2])
def test_quoted_line_breaks_across_blocks(spark, tmp_path, seed):
    """Equal to the reader that takes a file in one task, with files cut into many blocks."""
    rng = random.Random(seed)
    for k in range(3):
        lines = ["key,note,more"]
        for i in range(400):
            note = "".join(rng.choice(["w", " ", ",", '""', "\n", "\n\n", "\r\n", "é"]) for _ in range(rng.randrange(60)))
            lines.append(f'{k}-{i},"{note}",{rng.choice(["x", "", chr(34) * 2])}')
        (tmp_path / f"{k}.csv").write_text("\n".join(lines) + "\n", newline="")
    whole = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path))
    expected = rows(whole.select(*[parsing.null_tokens(F.col(c)).alias(c) for c in whole.columns]))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        found = readers.scan_text(spark, str(tmp_path), sequence=True, multiline=True)
        assert found.select(f"{readers.SEQUENCE}.file_block_start").distinct().count() > 10
        assert sorted(map(str, rows(found.drop(readers.SEQUENCE)))) == sorted(map(str, expected)) and len(expected) == 1200
        first = found.orderBy(readers.SEQUENCE).limit(401).collect()
        assert [r.key for r in first] == [f"0-{i}" for i in range(400)] + ["1-0"]
        assert readers.broken_records(spark, str(tmp_path), multiline=True).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_quote_that_is_never_closed(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n1,"x\n2,y\n3,z\n')
    lines = spark.read.text(str(tmp_path)).select("value", readers._place(F.monotonically_increasing_id()))
    assert sorted(r.value for r in readers.joined_lines(lines).collect()) == ['1,"x\n2,y\n3,z', "a,b"]
    assert sorted(r.value for r in readers.joined_lines(lines, longest=8).collect()) == ['1,"x', "2,y", "3,z", "a,b"]
    assert sum(r.rows for r in readers.broken_records(spark, str(tmp_path), multiline=True).collect()) == 1


def failing(df):
    return df.select(*[F.when(F.rand() < 2, F.raise_error(F.lit("lost"))).cast(t).alias(n) for n, t in df.dtypes])


def test_a_failure_leaves_the_old_tables_readable(spark, tmp_path):
    catalog = warehouse.products(spark.createDataFrame([("p1",)], "product_id string"))
    facts = warehouse.fact(spark.createDataFrame([("t1", "2020-01-01", "c", "p1")], "transaction_id string, order_date string, customer_id string, product_id string"))
    more = warehouse.products(spark.createDataFrame([("p1",), ("p2",)], "product_id string"))
    folder = str(tmp_path / "dw")
    with pytest.raises(FileNotFoundError):
        sinks.published(spark, folder)
    first = sinks.publish(spark, {"products": catalog, "transactions": facts}, folder, {"transactions": "order_year"})
    with pytest.raises(Exception, match="lost"):
        sinks.publish(spark, {"products": more, "transactions": failing(facts)}, folder, {"transactions": "order_year"})
    tables = sinks.published(spark, folder)
    assert sinks.manifest(spark, folder)["version"] == first and (tables["products"].count(), tables["transactions"].count()) == (1, 1)
    assert tables["products"].columns == catalog.columns and rows(tables["transactions"]) == rows(facts)
    second = sinks.publish(spark, {"products": more, "transactions": facts}, folder, {"transactions": "order_year"})
    assert sinks.published(spark, folder)["products"].count() == 2 and tables["products"].count() == 1
    assert first in sinks.drop_versions(spark, folder, keep=1) and sinks.manifest(spark, folder)["version"] == second
    assert sinks.published(spark, folder)["products"].count() == 2

    for table in ("products", "transactions"):
        sinks.create_table(spark, table, f"k_{table}", str(tmp_path / f"k_{table}"))
    names = {"products": "k_products", "transactions": "k_transactions"}
    sinks.reload_tables({"products": catalog, "transactions": facts}, names)
    with pytest.raises(Exception, match="lost"):
        sinks.reload_tables({"products": more, "transactions": failing(facts)}, names)
    assert (spark.table("k_products").count(), spark.table("k_transactions").count()) == (1, 1)
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")


def test_a_load_exchanges_only_keys(spark):
    facts = spark.createDataFrame([("t1", "2020-01-01", "c1", "p1", "UPI", 0), ("t1", "2020-01-02", "c1", "p1", "COD", 1)],
                                  "transaction_id string, order_date string, customer_id string, product_id string, payment_method string, i int")
    tables = warehouse.build(facts, spark.createDataFrame([("p1",)], "product_id string"), ["i"], ["product_id"])
    plan = plan_of(tables["transactions"])
    assert "payment_method" in plan and not re.search(r"Exchange (hash|range)partitioning", plan)
    assert [(r.transaction_id, r.payment_method) for r in tables["transactions"].collect()] == [("t1", "UPI")]
    assert [(r.payment_method, r.problems[0].rule) for r in tables["rejected_transactions"].collect()] == [("COD", "repeated")]


def test_a_stopped_run_goes_on_where_it_stopped(spark, tmp_path):
    asked = []

    def question(name, stop=False):
        def ask(t, c):
            asked.append(name)
            if stop:
                raise KeyboardInterrupt
            return t
        return ask

    t, folder = spark.range(3), str(tmp_path)
    with pytest.raises(KeyboardInterrupt):
        jobs.run_all(t, t, folder, {"a": question("a"), "b": question("b", stop=True), "c": question("c")}, run=jobs.Run(spark, folder, "x"))
    again = jobs.run_all(t, t, folder, {"a": question("a"), "b": question("b"), "c": question("c")}, run=jobs.Run(spark, folder, "x"))
    assert again == {"a": "kept", "b": "written", "c": "written"} and asked == ["a", "b", "b", "c"]
    assert set(jobs.run_all(t, t, folder, {"a": question("a")}, run=jobs.Run(spark, folder, "y")).values()) == {"written"}
    (tmp_path / "in.csv").write_text("a\n1\n")
    one = jobs.inputs(spark, str(tmp_path / "in.csv"), str(tmp_path / "none"))
    assert one == jobs.inputs(spark, str(tmp_path / "in.csv"), str(tmp_path / "none")) and "absent" in one
    (tmp_path / "in.csv").write_text("a\n22\n")
    assert one != jobs.inputs(spark, str(tmp_path / "in.csv"), str(tmp_path / "none"))


def test_append_and_reload_of_catalog_tables(spark, tmp_path):
    for table in ("products", "transactions"):
        sinks.create_table(spark, table, f"r_{table}", str(tmp_path / table))
    catalog = warehouse.products(spark.createDataFrame([("p1",), ("p2",)], "product_id string"))
    facts = warehouse.fact(spark.createDataFrame([("t1", "2020-01-01", "c", "p1"), ("t2", "2021-01-01", "c", "p2")], "transaction_id string, order_date string, customer_id string, product_id string"))
    names = {"products": "r_products", "transactions": "r_transactions"}
    for _ in range(2):
        sinks.reload_tables({"products": catalog, "transactions": facts}, names)
        assert (spark.table("r_products").count(), spark.table("r_transactions").count()) == (2, 2)
    sinks.append_table(facts.withColumn("transaction_id", F.concat("transaction_id", F.lit("x"))), "r_transactions")
    assert sorted(r.transaction_id for r in spark.table("r_transactions").filter("order_year = 2021").collect()) == ["t2", "t2x"]
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")


def test_one_failing_question_does_not_stop_the_run(spark, sf_dir, tmp_path):
    chosen = {"broken": lambda t, c: t.select("no_such_column"), **{n: jobs.ANALYSES[n] for n in ("kpis", "category_revenue")}}
    outcome = jobs.run_all(bindings.transactions(spark, sf_dir), bindings.products(spark, sf_dir), str(tmp_path), chosen)
    assert outcome["broken"].startswith("failed") and outcome["kpis"] == outcome["category_revenue"] == "written"
    assert spark.read.parquet(str(tmp_path / "kpis")).count() == 5


def test_stream_agrees_with_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_type = 'purchase'").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("decimal(12,2)").alias("amount"), F.col("user_id").cast("string").alias("customer_id"))
    closing = spark.sql("select timestamp'2030-01-01' ts, cast(0 as decimal(12,2)) amount, 'x' customer_id")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    closing.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = monitor.sales_stream(spark, str(tmp_path / "in"), events.schema, 1)
    for _ in range(2):  # the second run closes the days behind the watermark
        monitor.keep_daily_sales(stream, str(tmp_path / "days"), str(tmp_path / "state")).awaitTermination(120)
    days = spark.read.parquet(str(tmp_path / "days"))
    batch = events.groupBy(F.to_date("ts").alias("day")).agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    assert rows(days.select("day", "revenue", "orders")) == rows(batch)
    assert monitor.month_so_far(days).collect()[0].orders == events.filter("date_format(ts, 'yyyy-MM') = '2024-01'").count()


def test_the_load_stages_its_input_once_and_exchanges_no_whole_rows(spark, sf_dir, tmp_path):
    from tradewind import session
    before = set(session.stages(spark))
    built = warehouse.build(bindings.transactions(spark, sf_dir), bindings.products(spark, sf_dir), ["order_date", "transaction_id"], ["product_id"])
    labels = [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in session.stages(spark) if p not in before]
    assert labels.count("orders") == 1 and "review" not in labels
    plan = built["transactions"]._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and "Exchange hashpartitioning" not in plan
    loaded = warehouse.load(spark, built, str(tmp_path / "w"))
    assert loaded["transactions"].count() == bindings.transactions(spark, sf_dir, "transaction_id").count()
