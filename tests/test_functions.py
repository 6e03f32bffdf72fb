"""Golden inputs for the column functions."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tradewind import functions as fn


def apply(spark, function, values, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(function("v")).collect()]


CASES = {
    "price": (fn.clean_price, {
        "1299": 1299.0, "₹1,299": 1299.0, "₹1,299.50": 1299.5, "1,50,000": 150000.0, "1.5 lakh": 150000.0,
        "2 Cr": 2e7, "10k": 1e4, "3 million": 3e6, "2 billion": 2e9, "Price on request": None,
        "Not Available": None, "NA": None, "": None, "₹": None, "1.2.3": 1.23, "-50": -50.0, "5-10": None,
        "Rs. 1,299.00": 1299.0, "Final 500": 500.0, "5 kg": 5.0, "12 months": 12.0, "1,50 lakh": 1.5e7,
        "INR 75": 75.0, "abc": None, None: None,
    }),
    "rating": (fn.clean_rating, {
        "4/5": 4.0, "8/10": 4.0, "90/100": 4.5, "6/5": 6.0, "3/0": 3.0, "4.5 out of 5": 4.5, "4 stars": 4.0,
        "7": 3.5, "10": 5.0, "11": None, "0.5": 0.25, "good": None, None: None,
    }),
    "date": (fn.clean_date, {
        **{text: dt.date(2019, 3, 5) for text in (
            "2019-03-05", "05/03/2019", "05-03-19", "05-03-2019", "05/03/19", "2019/03/05", "5 Mar 2019",
            "5 March 2019", "2019-3-5", "5/3/2019", "2019-03-05 10:20:30", "2019-03-05T10:20:30", "Mar 5, 2019",
            "March 5th, 2019", " 2019-03-05 ",
        )},
        **{text: dt.date(2019, 6, 5) for text in (
            "05/06/2019 14:30", "05.06.2019", "20190605", "5 June, 2019", "Wed 5 Jun 2019", "5-Jun-2019", "05-Jun-19", "Jun 5, 2019 10:00 AM",
            "2019 Jun 5", "2019-June-05", "2019, Jun 5th", "Wednesday, June 5th, 2019", "5.6.19", "5 jun 2019 9:05:07.25 p.m.",
        )},
        "5 Sept 2019": dt.date(2019, 9, 5), "Sept 5 2019": dt.date(2019, 9, 5), "05-Jun-75": dt.date(1975, 6, 5), "31/06/2019 14:30": None, "31.06.2019": None,
        "20190631": None, "2019 Jun 31": None, "2019 Jun": None, "2019 Juni 5": None, "31 June, 2019": None, "Wed 31 Jun 2019": None, "31-Jun-2019": None, "31-Jun-19": None, "31 Sept 2019": None, "Jun 31, 2019 10:00 AM": None,
        "05/06/2019 25:30": None, "5 Juni 2019": None, "Wed": None, "10:00": None,
        "01-02-75": dt.date(1975, 2, 1), "01-02-68": dt.date(2068, 2, 1), "5th of June 2018": dt.date(2018, 6, 5),
        "March 2019": None, "garbage": None, "2015-02-30": None, "2015-13-45": None, "2019": None, "": None,
        None: None,
    }),
    "city": (fn.clean_city, {
        "BLR": "Bengaluru", "bombay!!": "Mumbai", "Delhi/NCR": "New Delhi", "Bangalore Urban": "Bengaluru",
        "MUMBRA": "Mumbai", "jaipur": "Jaipur", "": None, "none": None, "??": None, None: None,
        "navi   pune": "Pune",
    }),
    "bool": (fn.clean_bool, {
        "Yes": True, "0.0": False, "2": True, "Prime": True, "non-prime": True, "abc": False, None: False,
        "0.00": False, " T ": True, "nan": False,
    }),
    "delivery": (fn.clean_delivery_days, {
        "Same day": 0, "3-5 days": 4, "2-3": 2, "3-4": 4, "45": None, "1 week": 1, "express": None, "": None,
        None: None, "1-2-9": 2, "99999999999999999999": None, "30": 30,
    }),
    "payment": (fn.clean_payment, {
        "PhonePe": "UPI", "Paytm Wallet": "UPI", "Cash on Delivery": "COD", "VISA card": "Credit Card",
        "Debit Card": "Debit Card", "Net Banking": "NetBanking", "Mobikwik": "Wallet", "Gift card": "Gift Card",
        "C.O.D": "COD", "success": "Success", "CC": "Credit Card", None: None,
    }),
    "brand": (fn.clean_brand, {"h&m": "H&M", "o'neil & co.": "Oneil & Co", "co-op": "Co-Op", None: None}),
    "category": (fn.clean_category, {
        "Electronic Items": "Electronics", "Automobile": "Mobiles & Accessories", "E-Books": "Books",
        "Women Clothing": "Fashion", "toys": "Toys", "HOME  & Living": "Home & Kitchen", None: None,
    }),
    "title": (fn.title_case, {"a1b c-d": "A1B C-D", "HELLO wORLD": "Hello World", "": "", None: None}),
    "product_id": (fn.clean_product_id, {" p1 ": "P1", "": None, "  ": None, None: None}),
    "product_name": (fn.clean_product_name, {" ring ": "ring", "": "UNKNOWN_PRODUCT", None: "UNKNOWN_PRODUCT"}),
    "null_tokens": (fn.null_tokens, {"NA": None, " nan ": None, "x": "x", "": None, None: None}),
    "blank": (fn.blank_to_null, {"": None, "nan": None, "http": "http", None: None}),
    "strip": (fn.strip_numeric, {"₹1,234.5": 1234.5, "12%": 12.0, "1.2.3": None, "": None, "abc": None, None: None}),
    "ints": (fn.coerce_int, {"3": 3, "3.0": 3, "2.5": None, "x": None, "nan": None, "99999999999": None, None: None}),
    "flag": (fn.flag_from_text, {"TRUE": True, "0": False, "NULL": None, "": None, "yes": None, None: None}),
    "lenient": (fn.lenient_flag, {"Y": True, "True": True, "no": False, None: False}),
}


@pytest.mark.parametrize("name", CASES)
def test_golden(spark, name):
    function, table = CASES[name]
    assert apply(spark, function, list(table)) == list(table.values())


def test_age_edges(spark):
    ages = [0, 18, 19, 25, 26, 200, 201, None]
    assert apply(spark, fn.age_bucket, ages, "int") == [None, "<18", "18-24", "18-24", "25-34", "65+", None, None]


def test_labels(spark):
    assert apply(spark, fn.format_currency, [1234.4, 0.0, -1234.0, None], "double") == ["₹1,234", "₹0", "₹-1,234", "N/A"]
    assert apply(spark, fn.format_percent, [0.1234, None], "double") == ["12.3%", "N/A"]


def test_decimal_conformance(spark):
    assert [str(v) for v in apply(spark, lambda c: fn.to_decimal(c, 5, 2), ["1.005", "99999", "x"])] == [
        "1.01", "None", "None",
    ]


def test_headers():
    assert fn.snake_header(" Order Date ") == "order_date"
    assert fn.ascii_header("﻿Prix (€) d'été ") == "prix_d_ete"


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=25), min_size=60, max_size=60))
def test_nothing_raises(spark, texts):
    frame = spark.createDataFrame([(t.replace("\x00", ""),) for t in texts], "v string")
    functions = [case[0] for case in CASES.values()]
    assert frame.select(*[f("v").alias(f"c{i}") for i, f in enumerate(functions)]).count() == len(texts)
    frame.select(*[f("v").alias(f"c{i}") for i, f in enumerate(functions)]).collect()
