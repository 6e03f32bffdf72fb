"""Retail tables over the benchmark parquet files.

Columns are chosen by name and only the tables they come from are read and joined. All dimension
joins are left joins on a primary key, so leaving one out never changes the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import age_bucket

# prices and discounts have two decimals, so cents and percents are whole numbers
_CENTS = "cast(rint(l_extendedprice * 100) as bigint)"
_PERCENT = "cast(rint(l_discount * 100) as bigint)"
_PRICE = f"cast(cast({_CENTS} as decimal(18,0)) * 0.01BD as decimal(12,2))"
_AMOUNT = f"cast(cast({_CENTS} * (100 - {_PERCENT}) as decimal(18,0)) * 0.0001BD as decimal(14,4))"

# column -> (expression, tables beside lineitem)
_TRANSACTION = {
    "transaction_id": (
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, date_format(l_shipdate, 'yyyy-MM-dd'), "
        f"cast({_PRICE} as string))", ""),
    "order_date": ("o_orderdate", "o"),
    "order_year": ("year(o_orderdate)", "o"),
    "order_month": ("month(o_orderdate)", "o"),
    "customer_id": ("cast(o_custkey as string)", "o"),
    "product_id": ("cast(l_partkey as string)", ""),
    "product_name": ("p_name", "p"),
    "category": ("p_type", "p"),
    "brand": ("p_brand", "p"),
    "price": ("cast(p_retailprice as decimal(12,2))", "p"),
    "original_price_inr": (_PRICE, ""),
    "discount_percent": (f"cast({_PERCENT} as decimal(8,2))", ""),
    "final_amount": (_AMOUNT, ""),
    "quantity": ("cast(l_quantity as int)", ""),
    "customer_state": ("n_name", "ocn"),
    "customer_city": ("concat('City_', o_custkey % 50)", "o"),
    "customer_tier": ("c_mktsegment", "oc"),
    "payment_method": (
        "case substr(o_orderpriority, 1, 1) when '1' then 'UPI' when '2' then 'COD' when '3' then 'Credit Card' "
        "when '4' then 'NetBanking' else 'Wallet' end", "o"),
    "is_prime_member": ("c_mktsegment = 'BUILDING'", "oc"),
    "is_festival_sale": ("month(o_orderdate) = 10", "o"),
    "customer_age": ("cast(o_custkey % 90 as int)", "o"),
    "customer_age_group": (None, "o"),
    "rating": ("p_size % 5 + 1", "p"),
    "delivery_days": ("cast(l_orderkey % 12 as int)", ""),
    "return_status": ("l_returnflag", ""),
}


_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table under its declared schema, so that no job has to look for one."""
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores where the scan alone has too few splits for costly row work.

    A large table has more splits than that and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def _joined(spark: SparkSession, sf_dir: str, needs: set[str], costly: bool = False) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    if costly:
        rows = spread(rows, "l_orderkey")
    if "o" in needs:
        orders = table(spark, sf_dir, "orders")
        if "c" in needs:
            customers = table(spark, sf_dir, "customer")
            if "n" in needs:
                nations = table(spark, sf_dir, "nation")
                customers = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "p" in needs:
        rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return rows


def transactions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per order line, with the columns asked for (all of them by default)."""
    names = list(columns) or list(_TRANSACTION)
    needs = set("".join(_TRANSACTION[name][1] for name in names))
    chosen = [
        (age_bucket(F.col("o_custkey") % 90) if name == "customer_age_group" else F.expr(_TRANSACTION[name][0])).alias(name)
        for name in names
    ]
    return _joined(spark, sf_dir, needs, costly="transaction_id" in names).select(*chosen)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog: one row per product."""
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as product_id", "p_name as product_name", "p_type as category",
        "p_brand as brand", "cast(p_retailprice as decimal(12,2)) as price", "p_size % 5 + 1 as rating",
    )


# --- untidy versions of the same tables, every column text --------------------------------------

_PRICE_TEXT = f"""case l_orderkey % 8
    when 0 then cast({_PRICE} as string)
    when 1 then concat('₹', cast(cast(l_extendedprice / 1000 as int) as string), ',',
                       lpad(cast(l_linenumber as string), 3, '0'))
    when 2 then concat(cast(cast(l_quantity as int) as string), '.5 lakh')
    when 3 then concat('Rs. ', cast({_PRICE} as string))
    when 4 then 'Price on request' when 5 then '' when 6 then null else 'abc' end"""
_DATE_TEXT = """case o_orderkey % 15
    when 0 then date_format(o_orderdate, 'yyyy-MM-dd') when 1 then date_format(o_orderdate, 'dd/MM/yyyy')
    when 2 then date_format(o_orderdate, 'dd-MM-yy') when 3 then date_format(o_orderdate, 'yyyy/MM/dd')
    when 4 then date_format(o_orderdate, 'dd MMM yyyy') when 6 then date_format(o_orderdate, "dd/MM/yyyy '14:30'")
    when 7 then date_format(o_orderdate, 'dd.MM.yyyy') when 8 then date_format(o_orderdate, 'yyyyMMdd')
    when 9 then date_format(o_orderdate, 'd MMMM, yyyy') when 10 then date_format(o_orderdate, 'EEE d MMM yyyy')
    when 11 then date_format(o_orderdate, 'd-MMM-yyyy') when 12 then date_format(o_orderdate, 'dd-MMM-yy')
    when 13 then replace(date_format(o_orderdate, 'd MMM yyyy'), 'Sep', 'Sept')
    when 14 then date_format(o_orderdate, "MMM d, yyyy '10:00 AM'") else 'garbage' end"""
_RATING_TEXT = """case l_partkey % 6
    when 0 then concat(l_linenumber % 5 + 1, '/5') when 1 then concat(2 * (l_linenumber % 5 + 1), '/10')
    when 2 then concat(l_linenumber % 5 + 1, ' stars') when 3 then '7' when 4 then 'good' end"""
_CITY_TEXT = """case o_custkey % 6
    when 0 then 'BLR' when 1 then 'bombay!!' when 2 then 'Delhi/NCR' when 3 then 'jaipur' when 4 then '' end"""
_FLAG_TEXT = "case o_custkey % 5 when 0 then 'Yes' when 1 then '0' when 2 then 'abc' when 3 then '2' end"
_DELIVERY_TEXT = """case l_orderkey % 5
    when 0 then 'Same day' when 1 then '2-3' when 2 then '3-5 days' when 3 then '45' else 'express' end"""
_PAYMENT_TEXT = """case o_orderkey % 6
    when 0 then 'PhonePe' when 1 then 'Cash on Delivery' when 2 then 'VISA card' when 3 then 'Net Banking'
    when 4 then 'Mobikwik' else 'Gift card' end"""
# every 100th order line appears twice; every second of those pairs carries no quantity
_COPIES = "sequence(1, case when l_orderkey % 100 = 0 then 2 else 1 end)"
_QUANTITY_TEXT = "case when l_orderkey % 200 = 0 then '0' else cast(cast(l_quantity as int) as string) end"
# some amounts are too large by powers of ten
_AMOUNT_TEXT = f"""cast({_AMOUNT}
    * case when l_orderkey % 700 = 0 then 100000 when l_orderkey % 500 = 0 then 100 else 1 end as string)"""

_RAW_TRANSACTION = {
    "transaction_id": (_TRANSACTION["transaction_id"][0], ""),
    "copy": ("copy", ""),
    "order_date": (_DATE_TEXT, "o"),
    "customer_id": ("cast(o_custkey as string)", "o"),
    "product_id": ("cast(l_partkey as string)", ""),
    "original_price_inr": (_PRICE_TEXT, ""),
    "final_amount": (_AMOUNT_TEXT, ""),
    "quantity": (_QUANTITY_TEXT, ""),
    "customer_rating": (_RATING_TEXT, ""),
    "customer_city": (_CITY_TEXT, "o"),
    "is_prime_member": (_FLAG_TEXT, "o"),
    "delivery_days": (_DELIVERY_TEXT, ""),
    "payment_method": (_PAYMENT_TEXT, "o"),
    "festival_name": ("case when month(o_orderdate) = 10 then 'Diwali' end", "o"),
    "return_status": ("l_returnflag", ""),
}


def raw_transactions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Untidy order lines with copies; ``(transaction_id, copy)`` tells rows apart."""
    names = list(columns) or list(_RAW_TRANSACTION)
    needs = set("".join(_RAW_TRANSACTION[name][1] for name in names))
    rows = _joined(spark, sf_dir, needs, costly=True).select("*", F.explode(F.expr(_COPIES)).alias("copy"))
    return rows.select(*[F.expr(_RAW_TRANSACTION[name][0]).alias(name) for name in names])


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy catalog: stray case and blanks in ids, missing ids, repeated products with gaps."""
    rows = table(spark, sf_dir, "part").select(
        "*", F.explode(F.expr("sequence(1, case when p_partkey % 40 = 0 then 2 else 1 end)")).alias("copy"))
    return rows.selectExpr(
        "p_partkey as row_no", "copy",
        "case when p_partkey % 97 = 1 then '' when p_partkey % 89 = 1 then null "
        "     when p_partkey % 3 = 0 then concat(' p', p_partkey, ' ') else concat('P', p_partkey) end as sku",
        "case when p_partkey % 31 = 0 then '  ' when p_partkey % 37 = 0 then null else concat(' ', p_name) end "
        "as item_name",
        "case p_partkey % 5 when 0 then cast(cast(p_retailprice as decimal(12,2)) as string) "
        "     when 1 then concat('Rs. ', cast(cast(p_retailprice as decimal(12,2)) as string)) "
        "     when 2 then concat(p_size, 'k') when 3 then concat('₹', p_size, ',500.00') else "
        "     case when p_partkey % 3 = 0 then '9 crore' else 'NA' end end as mrp",
        "case when copy = 2 then null when p_partkey % 2 = 0 then concat(lower(p_brand), ' & co.') else p_brand end "
        "as brand_name",
        "case p_partkey % 8 when 0 then 'Electronic Items' when 1 then 'MOBILES' when 2 then 'Women Clothing' "
        "     when 3 then 'Home  & Living' when 4 then 'E-Books' when 5 then null else lower(p_type) end as category",
        "case p_partkey % 4 when 0 then '' when 1 then 'nan' else concat('http://img/', p_partkey) end as image_url",
        "case p_partkey % 4 when 0 then concat(p_size % 5 + 1, '/5') when 1 then '8/10' when 2 then 'bad' end as rating",
    )
