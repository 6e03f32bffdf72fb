"""The same results in DuckDB SQL, written from the description of each question."""

from __future__ import annotations

# --- fixed values: written out here a second time, so that a wrong entry of the library shows ---------

AGE_EDGES = [0, 18, 25, 35, 45, 55, 65, 200]
AGE_LABELS = ['<18', '18-24', '25-34', '35-44', '45-54', '55-64', '65+']
PRICE_UNITS = {'lakh': 100000.0,
 'lac': 100000.0,
 'crore': 10000000.0,
 'cr': 10000000.0,
 'k': 1000.0,
 'm': 1000000.0,
 'million': 1000000.0,
 'billion': 1000000000.0}
CITY_ALIASES = {'bangalore': 'Bengaluru',
 'bengaluru': 'Bengaluru',
 'blr': 'Bengaluru',
 'mumbai': 'Mumbai',
 'bombay': 'Mumbai',
 'mum': 'Mumbai',
 'delhi': 'New Delhi',
 'new delhi': 'New Delhi',
 'ncr': 'New Delhi',
 'chennai': 'Chennai',
 'madras': 'Chennai',
 'kolkata': 'Kolkata',
 'calcutta': 'Kolkata',
 'pune': 'Pune',
 'hyderabad': 'Hyderabad',
 'ahmedabad': 'Ahmedabad',
 'gurgaon': 'Gurugram',
 'gurugram': 'Gurugram',
 'noida': 'Noida'}
PAYMENT_GROUPS = {'UPI': ['upi', 'gpay', 'google pay', 'phonepe', 'paytm', 'bhim', 'tez', 'googlepay'],
 'COD': ['cash on delivery', 'cod', 'c o d'],
 'Credit Card': ['credit card', 'creditcard', '\\bcc\\b', 'visa', 'mastercard', 'amex'],
 'Debit Card': ['debit card', 'debitcard'],
 'NetBanking': ['netbank', 'net banking', 'netbanking', 'internet banking', 'bank transfer', 'neft', 'rtgs'],
 'Wallet': ['wallet', 'paytm wallet', 'mobikwik']}
CATEGORY_SYNONYMS = {'electronics': 'Electronics',
 'electronic': 'Electronics',
 'electronics & accessories': 'Electronics',
 'mobiles': 'Mobiles & Accessories',
 'mobile': 'Mobiles & Accessories',
 'fashion': 'Fashion',
 'clothing': 'Fashion',
 'home & kitchen': 'Home & Kitchen',
 'home & living': 'Home & Kitchen',
 'books': 'Books',
 'beauty & personal care': 'Beauty & Personal Care'}
NA_TOKENS = ['', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None',
 'n/a', 'nan', 'null']

# --- tables --------------------------------------------------------------------------------------

_PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
_DISCOUNT = "CAST(l_discount AS DECIMAL(4,2))"
_ID = (f"concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'), CAST({_PRICE} AS VARCHAR))")


def _age(x: str) -> str:
    spans = zip(AGE_EDGES, AGE_EDGES[1:], AGE_LABELS)
    return "CASE " + " ".join(f"WHEN {x} > {lo} AND {x} <= {hi} THEN '{label}'" for lo, hi, label in spans) + " END"


T = f"""t AS (
  SELECT {_ID} AS transaction_id, o_orderdate AS order_date, CAST(year(o_orderdate) AS INTEGER) AS order_year,
    CAST(month(o_orderdate) AS INTEGER) AS order_month, CAST(o_custkey AS VARCHAR) AS customer_id,
    CAST(l_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
    CAST(p_retailprice AS DECIMAL(12,2)) AS price, {_PRICE} AS original_price_inr,
    CAST({_DISCOUNT} * 100 AS DECIMAL(8,2)) AS discount_percent,
    CAST({_PRICE} * (1 - {_DISCOUNT}) AS DECIMAL(14,4)) AS final_amount, CAST(l_quantity AS INTEGER) AS quantity,
    n_name AS customer_state, concat('City_', o_custkey % 50) AS customer_city, c_mktsegment AS customer_tier,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'UPI' WHEN '2' THEN 'COD' WHEN '3' THEN 'Credit Card'
      WHEN '4' THEN 'NetBanking' ELSE 'Wallet' END AS payment_method,
    c_mktsegment = 'BUILDING' AS is_prime_member, month(o_orderdate) = 10 AS is_festival_sale,
    CAST(o_custkey % 90 AS INTEGER) AS customer_age, {_age('(o_custkey % 90)')} AS customer_age_group,
    CAST(p_size % 5 + 1 AS INTEGER) AS rating, CAST(l_orderkey % 12 AS INTEGER) AS delivery_days,
    l_returnflag AS return_status, strftime(o_orderdate, '%Y-%m') AS ym
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""

R = f"""r AS (
  SELECT {_ID} AS transaction_id, CAST(copy AS INTEGER) AS copy,
    CASE o_orderkey % 15 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
      WHEN 2 THEN strftime(o_orderdate, '%d-%m-%y') WHEN 3 THEN strftime(o_orderdate, '%Y/%m/%d')
      WHEN 4 THEN strftime(o_orderdate, '%d %b %Y') WHEN 6 THEN strftime(o_orderdate, '%d/%m/%Y 14:30')
      WHEN 7 THEN strftime(o_orderdate, '%d.%m.%Y') WHEN 8 THEN strftime(o_orderdate, '%Y%m%d')
      WHEN 9 THEN strftime(o_orderdate, '%-d %B, %Y') WHEN 10 THEN strftime(o_orderdate, '%a %-d %b %Y')
      WHEN 11 THEN strftime(o_orderdate, '%-d-%b-%Y') WHEN 12 THEN strftime(o_orderdate, '%d-%b-%y')
      WHEN 13 THEN replace(strftime(o_orderdate, '%-d %b %Y'), 'Sep', 'Sept')
      WHEN 14 THEN strftime(o_orderdate, '%b %-d, %Y 10:00 AM') ELSE 'garbage' END AS order_date,
    CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
    CASE l_orderkey % 8 WHEN 0 THEN CAST({_PRICE} AS VARCHAR)
      WHEN 1 THEN concat('₹', CAST(floor(l_extendedprice / 1000) AS INTEGER), ',', lpad(CAST(l_linenumber AS VARCHAR), 3, '0'))
      WHEN 2 THEN concat(CAST(l_quantity AS INTEGER), '.5 lakh') WHEN 3 THEN concat('Rs. ', CAST({_PRICE} AS VARCHAR))
      WHEN 4 THEN 'Price on request' WHEN 5 THEN '' WHEN 6 THEN NULL ELSE 'abc' END AS original_price_inr,
    CAST(CAST({_PRICE} * (1 - {_DISCOUNT}) AS DECIMAL(14,4))
      * CASE WHEN l_orderkey % 700 = 0 THEN 100000 WHEN l_orderkey % 500 = 0 THEN 100 ELSE 1 END AS VARCHAR) AS final_amount,
    CASE WHEN l_orderkey % 200 = 0 THEN '0' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
    CASE l_partkey % 6 WHEN 0 THEN concat(l_linenumber % 5 + 1, '/5') WHEN 1 THEN concat(2 * (l_linenumber % 5 + 1), '/10')
      WHEN 2 THEN concat(l_linenumber % 5 + 1, ' stars') WHEN 3 THEN '7' WHEN 4 THEN 'good' END AS customer_rating,
    CASE o_custkey % 6 WHEN 0 THEN 'BLR' WHEN 1 THEN 'bombay!!' WHEN 2 THEN 'Delhi/NCR' WHEN 3 THEN 'jaipur'
      WHEN 4 THEN '' END AS customer_city,
    CASE o_custkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN '0' WHEN 2 THEN 'abc' WHEN 3 THEN '2' END AS is_prime_member,
    CASE l_orderkey % 5 WHEN 0 THEN 'Same day' WHEN 1 THEN '2-3' WHEN 2 THEN '3-5 days' WHEN 3 THEN '45'
      ELSE 'express' END AS delivery_days,
    CASE o_orderkey % 6 WHEN 0 THEN 'PhonePe' WHEN 1 THEN 'Cash on Delivery' WHEN 2 THEN 'VISA card'
      WHEN 3 THEN 'Net Banking' WHEN 4 THEN 'Mobikwik' ELSE 'Gift card' END AS payment_method,
    CASE WHEN month(o_orderdate) = 10 THEN 'Diwali' END AS festival_name, l_returnflag AS return_status
  FROM (SELECT *, unnest(range(1, CASE WHEN l_orderkey % 100 = 0 THEN 3 ELSE 2 END)) AS copy FROM lineitem)
    JOIN orders ON l_orderkey = o_orderkey)"""

P = """p AS (
  SELECT p_partkey AS row_no, CAST(copy AS INTEGER) AS copy,
    CASE WHEN p_partkey % 97 = 1 THEN '' WHEN p_partkey % 89 = 1 THEN NULL
      WHEN p_partkey % 3 = 0 THEN concat(' p', p_partkey, ' ') ELSE concat('P', p_partkey) END AS sku,
    CASE WHEN p_partkey % 31 = 0 THEN '  ' WHEN p_partkey % 37 = 0 THEN NULL ELSE concat(' ', p_name) END AS item_name,
    CASE p_partkey % 5 WHEN 0 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)
      WHEN 1 THEN concat('Rs. ', CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR))
      WHEN 2 THEN concat(p_size, 'k') WHEN 3 THEN concat('₹', p_size, ',500.00')
      ELSE CASE WHEN p_partkey % 3 = 0 THEN '9 crore' ELSE 'NA' END END AS mrp,
    CASE WHEN copy = 2 THEN NULL WHEN p_partkey % 2 = 0 THEN concat(lower(p_brand), ' & co.') ELSE p_brand END AS brand_name,
    CASE p_partkey % 8 WHEN 0 THEN 'Electronic Items' WHEN 1 THEN 'MOBILES' WHEN 2 THEN 'Women Clothing'
      WHEN 3 THEN 'Home  & Living' WHEN 4 THEN 'E-Books' WHEN 5 THEN NULL ELSE lower(p_type) END AS category,
    CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'nan' ELSE concat('http://img/', p_partkey) END AS image_url,
    CASE p_partkey % 4 WHEN 0 THEN concat(p_size % 5 + 1, '/5') WHEN 1 THEN '8/10' WHEN 2 THEN 'bad' END AS rating
  FROM (SELECT *, unnest(range(1, CASE WHEN p_partkey % 40 = 0 THEN 3 ELSE 2 END)) AS copy FROM part))"""

# --- scalar rules --------------------------------------------------------------------------------


def d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def mean(x: str = "final_amount") -> str:
    return f"{d(f'sum({x})')} / nullif({d(f'count({x})')}, 0)"


def total(x: str = "final_amount") -> str:
    return d(f"coalesce(sum({x}), 0)")


def ratio(a: str, b: str) -> str:
    return f"{d(a)} / nullif({d(b)}, 0)"


def date_of(x: str) -> str:
    shapes = {r"\d{4}-\d{1,2}-\d{1,2}": "%Y-%m-%d", r"\d{1,2}/\d{1,2}/\d{4}": "%d/%m/%Y", r"\d{1,2}-\d{1,2}-\d{2}": "%d-%m-%y",
              r"\d{4}/\d{1,2}/\d{1,2}": "%Y/%m/%d", r"\d{1,2} [A-Za-z]{3} \d{4}": "%d %b %Y", r"\d{2}/\d{2}/\d{4} 14:30": "%d/%m/%Y 14:30",
              r"\d{2}\.\d{2}\.\d{4}": "%d.%m.%Y", r"\d{8}": "%Y%m%d", r"\d{1,2} [A-Za-z]+, \d{4}": "%d %B, %Y", r"[A-Z][a-z]{2} \d{1,2} [A-Za-z]{3} \d{4}": "%a %d %b %Y",
              r"\d{1,2}-[A-Za-z]{3}-\d{4}": "%d-%b-%Y", r"\d{2}-[A-Za-z]{3}-\d{2}": "%d-%b-%y", r"\d{1,2} Sept \d{4}": "%d Sept %Y",
              r"[A-Za-z]{3} \d{1,2}, \d{4} 10:00 AM": "%b %d, %Y 10:00 AM"}
    return "(CASE " + " ".join(
        f"WHEN regexp_full_match({x}, '{shape}') THEN " + (f"try_strptime(replace({x}, ' Sept ', ' 9 '), '%d %m %Y')" if "Sept" in shape else f"try_strptime({x}, '{fmt}')")
        for shape, fmt in shapes.items()) + " END)"


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def price_of(x: str) -> str:
    bare = rf"replace(regexp_replace(lower(trim({x})), '^(₹|rs\.?|inr)\s*', ''), ',', '')"
    unit = r"([0-9]+(?:\.[0-9]+)?)\s*(lakh|lac|crore|cr|k|million|m|billion)\b"
    digits = rf"regexp_replace({bare}, '[^0-9.\-]', '', 'g')"
    factors = " ".join(f"WHEN '{name}' THEN {factor}" for name, factor in PRICE_UNITS.items())
    return rf"""(CASE WHEN trim({x}) = '' OR regexp_matches(lower({x}), 'price\s*on\s*request|not\s*available|\bna\b') THEN NULL
      WHEN regexp_matches({bare}, '{unit}') THEN
        TRY_CAST(regexp_extract({bare}, '{unit}', 1) AS DOUBLE) * CASE regexp_extract({bare}, '{unit}', 2) {factors} END
      ELSE TRY_CAST(CASE WHEN strpos({digits}, '.') > 0 THEN concat(split_part({digits}, '.', 1), '.',
        replace(substr({digits}, strpos({digits}, '.') + 1), '.', '')) ELSE {digits} END AS DOUBLE) END)"""


def rating_of(x: str) -> str:
    pair, one = r"([0-9]+(?:\.[0-9]+)?)\s*/\s*([0-9]+(?:\.[0-9]+)?)", r"([0-9]+(?:\.[0-9]+)?)"
    a, b = (f"TRY_CAST(regexp_extract({x}, '{pair}', {i}) AS DOUBLE)" for i in (1, 2))
    v = f"TRY_CAST(regexp_extract({x}, '{one}', 1) AS DOUBLE)"
    return f"""(CASE WHEN {b} > 0 AND {b} <> 5 THEN {a} / {b} * 5.0::DOUBLE WHEN {b} IS NOT NULL THEN {a}
      WHEN {v} BETWEEN 1 AND 5 THEN {v} WHEN {v} <= 10 THEN least(5.0::DOUBLE, {v} / 2) END)"""


def squeezed(x: str, drop: str, put: str = " ") -> str:
    return rf"trim(regexp_replace(regexp_replace({x}, '{drop}', '{put}', 'g'), '\s+', ' ', 'g'))"


def title_of(x: str) -> str:
    """Character by character: capital unless the one before is a letter."""
    return (f"list_reduce(list_transform(range(1, length({x}) + 1), lambda i: CASE WHEN i > 1 AND regexp_matches(substr({x}, i - 1, 1), "
            f"'[A-Za-z]') THEN lower(substr({x}, i, 1)) ELSE upper(substr({x}, i, 1)) END), lambda a, b: concat(a, b), '')")


def cases(pairs: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{value}'" for test, value in pairs) + f" ELSE {otherwise} END"


def city_of(x: str) -> str:
    s = squeezed(f"lower({x})", r"[^a-z0-9\s]")
    exact = [(f"{s} = '{alias}'", city) for alias, city in CITY_ALIASES.items()]
    part = [(f"contains({s}, '{alias}')", city) for alias, city in CITY_ALIASES.items()]
    return f"(CASE WHEN {s} IN ('', 'nan', 'none', 'na') THEN NULL WHEN {x} IS NOT NULL THEN {cases(exact + part, title_of(s))} END)"


def flag_of(x: str) -> str:
    s = f"lower(trim({x}))"
    return f"""(CASE WHEN {s} IN ('1','true','yes','y','t','1.0') THEN true WHEN {s} IN ('0','false','no','n','f','0.0') THEN false
      WHEN contains({s}, 'prime') THEN true ELSE TRY_CAST({s} AS DOUBLE) <> 0 END)"""


def days_of(x: str) -> str:
    numbers = rf"list_transform(regexp_extract_all({x}, '\d+'), lambda n: CAST(n AS DOUBLE))"
    middle = f"round_even(list_aggregate({numbers}, 'median'), 0)"
    return f"""(CASE WHEN contains(lower({x}), 'same') THEN 0 WHEN len({numbers}) > 0 AND {middle} BETWEEN 0 AND 30
      THEN CAST({middle} AS INTEGER) END)"""


def payment_of(x: str) -> str:
    s = f"regexp_replace(lower({x}), '[^a-z0-9 ]', ' ', 'g')"
    groups = [(" OR ".join(f"regexp_matches({s}, '{w}')" for w in words), name) for name, words in PAYMENT_GROUPS.items()]
    return f"({cases(groups, title_of(f'trim({s})'))})"


def category_of(x: str) -> str:
    s = squeezed(f"lower({x})", r"[^a-z0-9\s&]")
    groups = [(f"contains({s}, '{word}')", name) for word, name in CATEGORY_SYNONYMS.items()]
    return f"(CASE WHEN {x} IS NOT NULL THEN {cases(groups, title_of(s))} END)"


def brand_of(x: str) -> str:
    s = squeezed(x, r"[^A-Za-z0-9 &\-]", "")
    return f"(CASE WHEN {x} IS NOT NULL THEN {title_of(s)} END)"


def whole(x: str) -> str:
    n = f"TRY_CAST({x} AS DOUBLE)"
    return f"(CASE WHEN {n} = floor({n}) THEN TRY_CAST({n} AS INTEGER) END)"


def tokens(x: str) -> str:
    listed = ", ".join(f"'{token}'" for token in NA_TOKENS)
    return f"(CASE WHEN trim({x}) NOT IN ({listed}) THEN {x} END)"


ORACLES: dict[str, str] = {}


def on_t(name: str, body: str, *ctes: str) -> None:
    ORACLES[name] = f"WITH {', '.join([T, *ctes])} {body}"


def on_r(name: str, body: str, *ctes: str) -> None:
    ORACLES[name] = f"WITH {', '.join([R, *ctes])} {body}"


def on_p(name: str, body: str, *ctes: str) -> None:
    ORACLES[name] = f"WITH {', '.join([P, *ctes])} {body}"


# --- sources, projection, filters ----------------------------------------------------------------

_STAMP = "strftime(order_date, '%Y-%m-%d %H:%M:%S')"
on_t("canonical_transactions", f"""SELECT transaction_id, {_STAMP} AS order_date, order_year, order_month, {d('final_amount')} AS final_amount,
  product_id, product_name, category, customer_city, customer_state, customer_id, delivery_days, is_prime_member, rating,
  return_status, payment_method, {d('discount_percent')} AS discount_percent, is_festival_sale, CAST(NULL AS VARCHAR) AS festival_name,
  customer_age_group, {d('original_price_inr')} AS original_price_inr, quantity, brand FROM t""")
_ODD_NAME = """CASE WHEN row_no % 4 = 0 THEN item_name || chr(10) || '"second, line"' ELSE item_name END"""
on_p("scan_csv_strings", "SELECT " + ", ".join(f"{tokens(f'CAST({_ODD_NAME if c == 'item_name' else c} AS VARCHAR)')} AS {c}" for c in (
    "row_no", "copy", "sku", "item_name", "mrp", "brand_name", "category", "image_url", "rating")) + " FROM p")
on_t("scan_cleaned", f"SELECT transaction_id, {_STAMP} AS order_date, customer_id, product_id, {d('final_amount')} AS final_amount, quantity, is_festival_sale FROM t")
on_t("union_chunks", f"SELECT transaction_id, order_year, {d('final_amount')} AS final_amount FROM t")
on_t("sample_rows", f"SELECT {_STAMP} AS order_date, transaction_id, customer_id, {d('final_amount')} AS final_amount FROM t ORDER BY t.order_date, transaction_id LIMIT 100")
on_t("sample_by_hash", f"SELECT transaction_id, {d('discount_percent')} AS discount_percent, {d('final_amount')} AS final_amount FROM t ORDER BY md5(transaction_id), transaction_id LIMIT 5000")
ORACLES["align_schema"] = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category, CAST(NULL AS VARCHAR) AS subcategory,
  p_brand AS brand, CAST(NULL AS DOUBLE) AS base_price_2015, CAST(NULL AS DOUBLE) AS weight_kg, CAST(p_size % 5 + 1 AS DOUBLE) AS rating,
  CAST(NULL AS BOOLEAN) AS is_prime_eligible, CAST(NULL AS INTEGER) AS launch_year, CAST(NULL AS VARCHAR) AS model, p_retailprice AS price FROM part"""
on_t("derive_date_parts", "SELECT transaction_id, order_year, order_month, ym AS order_ym FROM t")
on_t("filter_year_month", f"SELECT transaction_id, order_year, order_month, {d('final_amount')} AS final_amount FROM t WHERE order_year = 1998 AND order_month = 10")
on_t("top_brand_semi_join", f"""SELECT transaction_id, brand, {d('final_amount')} AS final_amount FROM t
  WHERE brand IN (SELECT brand FROM t GROUP BY brand ORDER BY sum(final_amount) DESC, brand LIMIT 5)""")
ORACLES["dq_pk_violations"] = f"""WITH {R}, {P} SELECT 'transactions' AS table_name, transaction_id AS key, 'repeated' AS problem, count(*) AS rows
  FROM r GROUP BY transaction_id HAVING count(*) > 1
  UNION ALL SELECT 'products', id, CASE WHEN id IS NULL THEN 'missing' ELSE 'repeated' END, count(*) FROM (SELECT nullif(upper(trim(sku)), '') AS id FROM p)
  GROUP BY id HAVING id IS NULL OR count(*) > 1"""
on_r("dq_missing_values", """SELECT 'transactions' AS table_name, column_name, rows FROM (
  SELECT 'customer_city' AS column_name, count(*) AS rows FROM r WHERE customer_city IS NULL UNION ALL
  SELECT 'is_prime_member', count(*) FROM r WHERE is_prime_member IS NULL UNION ALL
  SELECT 'original_price_inr', count(*) FROM r WHERE original_price_inr IS NULL)""")
on_p("dq_orphans", """SELECT 'product_id' AS key_name, concat('P', l_partkey) AS key, count(*) AS rows FROM lineitem
  WHERE NOT EXISTS (SELECT 1 FROM p WHERE upper(trim(sku)) = concat('P', l_partkey)) GROUP BY l_partkey""")
on_r("conform_decimals", f"""SELECT transaction_id, copy, {d('TRY_CAST(TRY_CAST(final_amount AS DECIMAL(38,4)) AS DECIMAL(12,2))')} AS final_amount,
  {d('TRY_CAST(quantity AS DECIMAL(3,1))')} AS quantity FROM r""")
on_r("conform_rejects", """SELECT 'final_amount' AS rule, final_amount AS raw, count(*) AS rows FROM r
  WHERE TRY_CAST(TRY_CAST(final_amount AS DECIMAL(38,4)) AS DECIMAL(12,2)) IS NULL GROUP BY final_amount
  UNION ALL SELECT 'customer_rating', customer_rating, count(*) FROM r
  WHERE customer_rating IS NOT NULL AND TRY_CAST(customer_rating AS DECIMAL(3,1)) IS NULL GROUP BY customer_rating""")

# --- cleaning functions --------------------------------------------------------------------------

for _name, _raw, _clean in (
    ("clean_date", "order_date", iso(date_of("order_date"))), ("clean_price", "original_price_inr", price_of("original_price_inr")),
    ("clean_rating", "customer_rating", rating_of("customer_rating")), ("clean_city", "customer_city", city_of("customer_city")),
    ("clean_bool", "is_prime_member", f"coalesce({flag_of('is_prime_member')}, false)"),
    ("clean_delivery_days", "delivery_days", days_of("delivery_days")), ("clean_payment", "payment_method", payment_of("payment_method")),
    ("strip_numeric", "original_price_inr", r"TRY_CAST(regexp_replace(original_price_inr, '[^0-9.\-]', '', 'g') AS DOUBLE)"),
    ("coerce_ints", "final_amount", whole("final_amount")),
    ("flag_from_text", "is_prime_member", "CASE WHEN lower(trim(is_prime_member)) IN ('true', '1') THEN true WHEN lower(trim(is_prime_member)) IN ('false', '0') THEN false END"),
    ("lenient_flag", "is_prime_member", "coalesce(lower(is_prime_member) IN ('true', '1', 'yes', 'y', 't'), false)"),
):
    on_r(_name, f"SELECT transaction_id, copy, {_raw} AS raw, {_clean} AS clean FROM r")

_NAME = "coalesce(nullif(trim(item_name), ''), 'UNKNOWN_PRODUCT')"
for _name, _raw, _clean in (
    ("clean_product_name", "item_name", _NAME), ("clean_brand", "brand_name", brand_of("brand_name")),
    ("clean_category", "category", category_of("category")),
    ("title_case", "brand_name", f"CASE WHEN brand_name IS NOT NULL THEN {title_of('brand_name')} END"),
    ("null_tokens", "mrp", tokens("mrp")), ("blank_to_null", "image_url", "CASE WHEN image_url NOT IN ('', 'nan') THEN image_url END"),
):
    on_p(_name, f"SELECT row_no, copy, {_raw} AS raw, {_clean} AS clean FROM p")

IDS = """ids AS (SELECT *, CASE WHEN nullif(trim(sku), '') IS NULL
    THEN concat('MISSING_', row_number() OVER (PARTITION BY nullif(trim(sku), '') IS NULL ORDER BY row_no, copy)) ELSE upper(trim(sku)) END AS product_id FROM p)"""
on_p("clean_product_id", "SELECT product_id, row_no, copy FROM ids", IDS)
on_p("surrogate_ids", "SELECT concat('PID_', row_number() OVER (ORDER BY row_no, copy)) AS product_id, row_no, copy FROM p")
on_t("format_currency", """SELECT ym AS order_ym, concat('₹', format('{:,}', CAST(round_even(CAST(sum(final_amount) AS DOUBLE), 0) AS BIGINT))) AS shown FROM t GROUP BY ym""")

_RULES = {
    "order_date": ("order_date", date_of("order_date")),
    "original_price_inr_clean": ("original_price_inr", price_of("original_price_inr")),
    "final_amount": ("final_amount", price_of("final_amount")),
    "customer_rating": ("customer_rating", rating_of("customer_rating")),
    "customer_city": ("customer_city", city_of("customer_city")),
    "is_prime_member": ("is_prime_member", flag_of("is_prime_member")),
    "delivery_days": ("delivery_days", days_of("delivery_days")),
    "payment_method": ("payment_method", payment_of("payment_method")),
}


def rejected(*rules: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, {raw} AS raw, count(*) AS rows FROM r WHERE {raw} IS NOT NULL AND {clean} IS NULL GROUP BY {raw}"
        for rule, (raw, clean) in _RULES.items() if rule in rules)


for _name, _rule in (("rejects_dates", "order_date"), ("rejects_price", "original_price_inr_clean"), ("rejects_city", "customer_city"), ("rejects_bool", "is_prime_member")):
    on_r(_name, rejected(_rule))
on_r("rejects_all", rejected(*_RULES))
on_r("map_payment_pairs", f"SELECT payment_method AS raw, {payment_of('payment_method')} AS clean, count(*) AS rows FROM r GROUP BY payment_method")

# --- duplicates, outliers, pipelines -------------------------------------------------------------

V = f"""v AS (SELECT transaction_id, copy, customer_id, product_id, CAST({date_of('order_date')} AS DATE) AS order_date,
    CAST({price_of('final_amount')} AS DECIMAL(18,4)) AS final_amount, quantity,
    CAST({price_of('original_price_inr')} AS DECIMAL(18,4)) AS original_price_inr_clean, original_price_inr,
    {rating_of('customer_rating')} AS customer_rating, {city_of('customer_city')} AS customer_city,
    coalesce({flag_of('is_prime_member')}, false) AS is_prime_member, {days_of('delivery_days')} AS delivery_days,
    {payment_of('payment_method')} AS payment_method, festival_name, return_status FROM r)"""
W = """w AS (SELECT *, count(*) OVER g AS n, sum(coalesce(TRY_CAST(quantity AS DOUBLE), 0)) OVER g AS q,
    row_number() OVER (PARTITION BY customer_id, product_id, order_date, final_amount ORDER BY transaction_id, copy) AS i
  FROM v WINDOW g AS (PARTITION BY customer_id, product_id, order_date, final_amount))"""
_KEYS = f"customer_id, product_id, {iso('order_date')} AS order_date, {d('final_amount')} AS final_amount"
on_r("dup_groups", f"SELECT {_KEYS}, count(*) AS rows, sum(coalesce(TRY_CAST(quantity AS DOUBLE), 0)) AS quantity FROM v GROUP BY ALL HAVING count(*) > 1".replace("GROUP BY ALL", "GROUP BY customer_id, product_id, v.order_date, v.final_amount"), V)
on_r("dup_erroneous", f"SELECT transaction_id, copy, {_KEYS}, quantity FROM w WHERE n > 1 AND q <= 1", V, W)
on_r("dedupe_transactions", f"SELECT transaction_id, copy, {_KEYS}, quantity FROM w WHERE NOT (n > 1 AND q <= 1 AND i > 1)", V, W)


def repaired(source: str) -> tuple[str, str]:
    med = f"med AS (SELECT product_id, quantile_cont({d('final_amount')}, 0.5) AS m FROM {source} GROUP BY product_id)"
    p = d("final_amount")
    fix = f"""fix AS (SELECT *, CASE WHEN m > 0 AND {p} > m * 50 THEN CASE
        WHEN {p} / 10 BETWEEN m * 0.5 AND m * 5 THEN '10' WHEN {p} / 100 BETWEEN m * 0.5 AND m * 5 THEN '100'
        WHEN {p} / 1000 BETWEEN m * 0.5 AND m * 5 THEN '1000' ELSE 'flag' END END AS repair FROM {source} JOIN med USING (product_id))"""
    return med, fix


_FIXED = f"CASE WHEN repair <> 'flag' THEN {d('final_amount')} / CAST(repair AS DOUBLE) ELSE {d('final_amount')} END".replace("CAST(repair AS DOUBLE)", "TRY_CAST(repair AS DOUBLE)")
_FIXED = f"round({_FIXED}, 4)"
on_r("price_outliers_fixed", f"SELECT transaction_id, copy, product_id, {_FIXED} AS final_amount, {d('final_amount')} AS amount_before, repair, round(m, 4) AS ref_median FROM fix WHERE repair <> 'flag'", V, *repaired("v"))
on_r("price_outliers_flagged", f"SELECT transaction_id, copy, product_id, {d('final_amount')} AS final_amount, repair, round(m, 4) AS ref_median FROM fix WHERE repair = 'flag'", V, *repaired("v"))
_KEPT = "kept AS (SELECT * FROM w WHERE NOT (n > 1 AND q <= 1 AND i > 1))"
on_r("clean_transactions", f"""SELECT transaction_id, copy, {iso('order_date')} AS order_date, customer_id, product_id, original_price_inr, {_FIXED} AS final_amount, quantity,
  customer_rating, customer_city, is_prime_member, delivery_days, payment_method, festival_name, return_status,
  {d('original_price_inr_clean')} AS original_price_inr_clean FROM fix""", V, W, _KEPT, *repaired("kept"))

C = f"""c AS (SELECT product_id, row_no, copy, {_NAME} AS product_name, mrp, CAST({price_of('mrp')} AS DECIMAL(18,4)) AS price, brand_name,
    {brand_of('brand_name')} AS brand, {category_of('category')} AS category, CASE WHEN image_url NOT IN ('', 'nan') THEN image_url END AS image_url,
    {rating_of('rating')} AS rating FROM ids)"""
K = """k AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY
    2 * CAST(price IS NULL AS INTEGER) + CAST(brand_name IS NULL AS INTEGER) + CAST(brand IS NULL AS INTEGER)
    + CAST(category IS NULL AS INTEGER) + CAST(image_url IS NULL AS INTEGER) + CAST(rating IS NULL AS INTEGER), row_no, copy) = 1)"""
on_p("dedupe_products", "SELECT product_id, row_no, copy, brand FROM k", IDS, C, K)
on_p("product_price_flags", f"SELECT product_id, row_no, copy, {d('price')} AS price FROM c WHERE {d('price')} > (SELECT quantile_cont({d('price')}, 0.5) * 100 FROM c)", IDS, C)
on_p("clean_products", f"""SELECT product_id, row_no, copy, product_name, mrp, {d('price')} AS mrp_clean, {d('price')} AS price, brand_name, brand, category, image_url, rating FROM k""", IDS, C, K)
_PRODUCT_REJECTS = f"""SELECT 'mrp_clean' AS rule, mrp AS raw FROM p WHERE mrp IS NOT NULL AND {price_of('mrp')} IS NULL GROUP BY mrp
  UNION ALL SELECT 'rating', rating FROM p WHERE rating IS NOT NULL AND {rating_of('rating')} IS NULL GROUP BY rating"""
ORACLES["cleaning_summary"] = f"""WITH {", ".join([R, V, W, _KEPT, *repaired("kept"), P, IDS, C, K])}
  SELECT 'transactions_rows' AS metric, count(*) AS value FROM kept
  UNION ALL SELECT 'products_rows', count(*) FROM k
  UNION ALL SELECT concat('rejected_', rule), count(*) FROM ({rejected(*_RULES)}) GROUP BY rule
  UNION ALL SELECT concat('rejected_product_', rule), count(*) FROM ({_PRODUCT_REJECTS}) GROUP BY rule
  UNION ALL SELECT 'review_duplicates', count(*) FROM w WHERE n > 1 AND q <= 1
  UNION ALL SELECT 'review_repaired_amounts', count(*) FROM fix WHERE repair <> 'flag'
  UNION ALL SELECT 'review_flagged_amounts', count(*) FROM fix WHERE repair = 'flag'
  UNION ALL SELECT 'review_extreme_prices', count(*) FROM k WHERE {d('price')} > (SELECT quantile_cont({d('price')}, 0.5) * 100 FROM k)
  UNION ALL SELECT 'products_with_category', count(category) FROM k"""

# --- star schema ---------------------------------------------------------------------------------

_CENTS = "CAST((CAST(sum(final_amount) * 10000 AS HUGEINT) + 50 * count(*)) // (100 * count(*)) AS DOUBLE) / 100"
on_t("dim_customers", f"""SELECT customer_id, min(customer_city) AS customer_city, min(customer_state) AS customer_state, min(customer_tier) AS customer_tier,
  CAST(NULL AS VARCHAR) AS customer_spending_tier, min(customer_age_group) AS customer_age_group, bool_or(is_prime_member) AS is_prime_member,
  {d('CAST(sum(final_amount) AS DECIMAL(14,2))')} AS lifetime_value, CAST(count(*) AS INTEGER) AS total_orders, {_CENTS} AS avg_order_value FROM t GROUP BY customer_id""")
on_t("dim_time", f"""SELECT {iso('day')} AS date_id, CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter, CAST(month(day) AS INTEGER) AS month,
  monthname(day) AS month_name, CAST(weekofyear(day) AS INTEGER) AS week_of_year, CAST(dayofmonth(day) AS INTEGER) AS day_of_month, dayname(day) AS day_name,
  isodow(day) IN (6, 7) AS is_weekend FROM (SELECT unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS day FROM t)""")
on_p("dim_products", f"""SELECT product_id, product_name, category, CAST(NULL AS VARCHAR) AS subcategory, brand, CAST(NULL AS DOUBLE) AS base_price_2015,
  CAST(NULL AS DOUBLE) AS weight_kg, round(rating, 1) AS rating, CAST(NULL AS BOOLEAN) AS is_prime_eligible, CAST(NULL AS INTEGER) AS launch_year,
  CAST(NULL AS VARCHAR) AS model, {d('CAST(price AS DECIMAL(12,2))')} AS price FROM k""", IDS, C, K)
_NO = {"VARCHAR": ["subcategory", "customer_spending_tier", "delivery_type", "festival_name"],
       "DOUBLE": ["discounted_price_inr", "subtotal_inr", "delivery_charges", "final_amount_inr", "customer_rating", "product_weight_kg", "product_rating", "original_price_inr_clean"],
       "BOOLEAN": ["is_prime_eligible"]}
on_t("fact_transactions", f"""SELECT transaction_id, {_STAMP} AS order_date, customer_id, product_id, product_name, category, brand, {d('original_price_inr')} AS original_price_inr,
  {d('discount_percent')} AS discount_percent, quantity, customer_city, customer_state, customer_tier, customer_age_group, payment_method, delivery_days, is_prime_member,
  is_festival_sale, return_status, order_month, order_year, CAST(quarter(t.order_date) AS INTEGER) AS order_quarter,
  {d('CAST(final_amount AS DECIMAL(12,2))')} AS final_amount, """ + ", ".join(f"CAST(NULL AS {kind}) AS {c}" for kind, names in _NO.items() for c in names) + " FROM t")
_COUNTS = """SELECT 'customers' AS table_name, count(DISTINCT customer_id) AS rows FROM t UNION ALL SELECT 'products', count(*) FROM part
  UNION ALL SELECT 'time_dimension', date_diff('day', min(order_date), max(order_date)) + 1 FROM t UNION ALL SELECT 'transactions', count(DISTINCT transaction_id) FROM t"""
on_t("warehouse_row_counts", _COUNTS)
on_t("warehouse_load", _COUNTS)
ORACLES["warehouse_rejects"] = f"""WITH {R}, {P}, o AS (
    SELECT transaction_id, copy, {date_of('order_date')} AS day, customer_id, CASE WHEN quantity = '9' THEN 'unknown' ELSE product_id END AS product_id,
      CASE WHEN quantity = '7' THEN '99999999999.5' ELSE final_amount END AS final_amount, delivery_days, customer_rating FROM r),
  fact AS (
    SELECT transaction_id, copy, product_id, day IS NULL AS no_day, abs(round(CAST(final_amount AS DOUBLE), 2)) >= 1e10 AS wide, final_amount, delivery_days <> '45' AS no_days, delivery_days,
      customer_rating, customer_rating IS NOT NULL AND (regexp_replace(customer_rating, '[^0-9.-]', '', 'g') = '' OR abs(try_cast(regexp_replace(customer_rating, '[^0-9.-]', '', 'g') AS DOUBLE)) >= 99.95) AS no_rating FROM o),
  item AS (SELECT regexp_extract(sku, '[0-9]+') AS id, rating, row_no, copy,
      rating IS NOT NULL AND (regexp_replace(rating, '[^0-9.-]', '', 'g') = '' OR abs(try_cast(regexp_replace(rating, '[^0-9.-]', '', 'g') AS DOUBLE)) >= 99.95) AS no_rating,
      coalesce(regexp_extract(sku, '[0-9]+'), '') = '' AS no_id, sku IS NULL AS null_id FROM p),
  fit_item AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY row_no, copy) AS n FROM item WHERE NOT no_rating AND NOT null_id),
  fit AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY copy) AS n FROM fact WHERE NOT no_day AND NOT wide AND NOT no_days AND NOT no_rating),
  told AS (
    SELECT 'transactions' AS table_name, 'missing' AS rule, 'order_date' AS column_name, CAST(NULL AS VARCHAR) AS raw FROM fact WHERE no_day
    UNION ALL SELECT 'transactions', 'misfit', 'final_amount', final_amount FROM fact WHERE wide
    UNION ALL SELECT 'transactions', 'misfit', 'delivery_days', delivery_days FROM fact WHERE no_days
    UNION ALL SELECT 'transactions', 'misfit', 'customer_rating', customer_rating FROM fact WHERE no_rating
    UNION ALL SELECT 'transactions', 'repeated', 'transaction_id', transaction_id FROM fit WHERE n > 1
    UNION ALL SELECT 'transactions', 'orphan', 'product_id', product_id FROM fit WHERE n = 1 AND product_id NOT IN (SELECT id FROM fit_item WHERE n = 1)
    UNION ALL SELECT 'products', 'missing', 'product_id', NULL FROM item WHERE null_id
    UNION ALL SELECT 'products', 'misfit', 'rating', rating FROM item WHERE no_rating
    UNION ALL SELECT 'products', 'repeated', 'product_id', id FROM fit_item WHERE n > 1)
  SELECT table_name, rule, column_name, raw, count(*) AS rows FROM told GROUP BY ALL"""
on_t("warehouse_checks", """SELECT 'transactions:repeated' AS check_name, transaction_id AS key, count(*) AS rows FROM t GROUP BY transaction_id HAVING count(*) > 1""")

# --- joins ---------------------------------------------------------------------------------------

for _attribute in ("category", "brand"):
    on_t(f"enrich_{_attribute}", f"SELECT transaction_id, product_id, {d('final_amount')} AS final_amount, {_attribute} FROM t")
on_t("avg_price_joinback", f"""SELECT transaction_id, product_id, {d('final_amount')} AS final_amount,
  {d('sum(final_amount) OVER w')} / {d('count(*) OVER w')} AS avg_order_price FROM t WINDOW w AS (PARTITION BY product_id)""")

# --- questions -----------------------------------------------------------------------------------

Y = "y AS (SELECT order_year AS year, sum(final_amount) AS revenue FROM t GROUP BY order_year)"
G = f"""g AS (SELECT year, revenue, CASE WHEN row_number() OVER (ORDER BY year) = 1 THEN 0
    ELSE {ratio('revenue - lag(revenue) OVER (ORDER BY year)', 'lag(revenue) OVER (ORDER BY year)')} * 100 END AS pct_growth FROM y)"""
on_t("yearly_revenue_growth", f"SELECT year, {d('revenue')} AS revenue, pct_growth FROM g", Y, G)
on_t("top_growth_years", f"SELECT year, {d('revenue')} AS revenue, pct_growth FROM g ORDER BY pct_growth DESC, year LIMIT 3", Y, G)
on_t("trend_yearly", f"""SELECT round(regr_slope({d('revenue')}, {d('year')}), 2) AS slope, round(regr_intercept({d('revenue')}, {d('year')}), 0) AS intercept,
  round(regr_r2({d('revenue')}, {d('year')}), 6) AS r2, {big(f"regr_count({d('revenue')}, {d('year')})")} AS rows FROM y""", Y)
_MONTHS = ", ".join(f"{d(f'coalesce(sum(final_amount) FILTER (order_month = {m}), 0)')} AS m{m:02d}" for m in range(1, 13))
on_t("pivot_year_month", f"SELECT order_year, {_MONTHS} FROM t GROUP BY order_year")
on_t("monthly_totals", f"SELECT order_month, {total()} AS revenue FROM t GROUP BY order_month")
on_t("category_seasonality", f"""SELECT category, order_year, {_MONTHS} FROM t
  WHERE category IN (SELECT category FROM t GROUP BY category ORDER BY sum(final_amount) DESC, category LIMIT 6) GROUP BY category, order_year""")
RFM = """rfm AS (SELECT customer_id, CAST(date_diff('day', max(order_date), (SELECT max(order_date) FROM t)) + 1 AS INTEGER) AS recency,
    count(order_date) AS frequency, sum(final_amount) AS monetary FROM t GROUP BY customer_id)"""
on_t("rfm", f"SELECT customer_id, recency, frequency, {d('monetary')} AS monetary FROM rfm", RFM)


def zscore(x: str) -> str:
    return f"round(({d(x)} - avg({d(x)}) OVER ()) / stddev_samp({d(x)}) OVER (), 6)"


on_t("rfm_zscores", f"SELECT customer_id, {zscore('recency')} AS recency_z, {zscore('frequency')} AS frequency_z, {zscore('greatest(monetary, 0)')} AS monetary_z FROM rfm", RFM)


def clustered(k: int = 4, starts: int = 10, passes: int = 40, race: int = 5, tolerance: float = 1e-4) -> str:
    """K-means over rfm as CTEs: ``named(customer_id, recency, frequency, monetary, segment)``."""
    axes = ("r", "f", "m")
    near = " + ".join(f"((CAST(p.{a} AS DOUBLE) - c.{a}) * s{a}) * ((CAST(p.{a} AS DOUBLE) - c.{a}) * s{a})" for a in axes)
    out = ["""whole AS MATERIALIZED (SELECT customer_id, recency, frequency, monetary, CAST(recency AS BIGINT) AS r, CAST(frequency AS BIGINT) AS f,
        CAST(trunc(greatest(monetary, 0) * 10000) AS BIGINT) AS m FROM rfm WHERE recency IS NOT NULL)""",
        "points AS MATERIALIZED (SELECT r, f, m, count(*) AS w FROM whole GROUP BY r, f, m)",
        "spreads AS MATERIALIZED (SELECT " + ", ".join(
            f"""CASE WHEN v{a} > 0 THEN 1.0::DOUBLE / sqrt(v{a}) ELSE 0 END AS s{a}""" for a in axes) + " FROM (SELECT " + ", ".join(
            f"q{a} / n - (t{a} / n) * (t{a} / n) AS v{a}" for a in axes) + " FROM (SELECT CAST(sum(w) AS DOUBLE) AS n, " + ", ".join(
            f"CAST(sum(CAST({a} AS HUGEINT) * w) AS DOUBLE) AS t{a}, CAST(sum(CAST({a} AS HUGEINT) * {a} * w) AS DOUBLE) AS q{a}" for a in axes) + " FROM points)))",
        f"""c0 AS MATERIALIZED (SELECT (i // {k}) AS start, (i % {k}) AS cluster, CAST(r AS DOUBLE) AS r, CAST(f AS DOUBLE) AS f, CAST(m AS DOUBLE) AS m, true AS moving, CAST(NULL AS DOUBLE) AS cost
        FROM (SELECT r, f, m, row_number() OVER (ORDER BY md5(concat_ws('|', r, f, m)), r, f, m) - 1 AS i FROM points) WHERE i < {k * starts})"""]
    for p in range(passes):
        entering = f"c{p}" if p != race else f"(SELECT * FROM c{p} WHERE start = (SELECT arg_min(start, (cost, start)) FROM c{p}))"
        means = ", ".join(f"CASE WHEN c.moving AND g.n IS NOT NULL THEN g.t{a} / g.n ELSE c.{a} END AS {a}" for a in axes)
        shift = " + ".join(f"(({a} - was_{a}) * s{a}) * (({a} - was_{a}) * s{a})" for a in axes)
        spent = " + ".join(f"(q{a} - n * {a} * {a}) * s{a} * s{a}" for a in axes)
        out += [f"""e{p} AS MATERIALIZED (SELECT * FROM {entering})""",
                f"""g{p} AS MATERIALIZED (SELECT start, cluster, CAST(sum(w) AS DOUBLE) AS n, {", ".join(f"CAST(sum(CAST({a} AS HUGEINT) * w) AS DOUBLE) AS t{a}, CAST(sum(CAST({a} AS HUGEINT) * {a} * w) AS DOUBLE) AS q{a}" for a in axes)}
                FROM (SELECT p.r, p.f, p.m, p.w, c.start, c.cluster FROM points p, (SELECT * FROM e{p} WHERE moving) c, spreads
                      QUALIFY row_number() OVER (PARTITION BY c.start, p.r, p.f, p.m ORDER BY {near}, c.cluster) = 1) GROUP BY start, cluster)""",
                f"""c{p + 1} AS MATERIALIZED (SELECT start, cluster, r, f, m, moving AND sum({shift}) OVER (PARTITION BY start) > {tolerance} AS moving,
                CASE WHEN moving THEN coalesce(sum({spent}) OVER (PARTITION BY start), 0) ELSE cost END AS cost
                FROM (SELECT c.start, c.cluster, {means}, c.r AS was_r, c.f AS was_f, c.m AS was_m, c.moving, c.cost, g.* EXCLUDE (start, cluster) FROM e{p} c LEFT JOIN g{p} g ON c.start = g.start AND c.cluster = g.cluster), spreads)"""]
    out.append(f"""ranked AS MATERIALIZED (SELECT *, CAST(row_number() OVER (ORDER BY m, cluster) - 1 AS INTEGER) AS segment FROM c{passes} WHERE start = (SELECT arg_min(start, (cost, start)) FROM c{passes}))""")
    out.append(f"""named AS (SELECT p.customer_id, p.recency, p.frequency, p.monetary, c.segment FROM whole p, ranked c, spreads
        QUALIFY row_number() OVER (PARTITION BY p.customer_id ORDER BY {near}, c.cluster) = 1)""")
    return ", ".join(out)


on_t("rfm_segments", f"SELECT customer_id, recency, frequency, {d('monetary')} AS monetary, segment FROM named", f"{RFM}, {clustered()}")
on_t("rfm_segment_summary", """SELECT segment, count(*) AS customers, CAST(sum(recency) AS DOUBLE) / count(*) AS avg_recency, CAST(sum(frequency) AS DOUBLE) / count(*) AS avg_frequency,
  CAST(sum(monetary) AS DOUBLE) / count(monetary) AS avg_monetary FROM named GROUP BY segment""", f"{RFM}, {clustered()}")
on_t("rfm_recency_quartile", f"""SELECT customer_id, recency, frequency, {d('monetary')} AS monetary,
  CAST(greatest(ceil((place - 1) * 4.0 / (n - 1)) - 1, 0) AS INTEGER) AS recency_q
  FROM (SELECT *, row_number() OVER (ORDER BY recency, customer_id) AS place, count(*) OVER () AS n FROM rfm)""", RFM)
on_t("payment_monthly_counts", "SELECT ym AS order_ym, payment_method, count(*) AS orders FROM t GROUP BY ALL")
on_t("payment_monthly_share", f"SELECT order_ym, payment_method, {d('orders')} / {d('sum(orders) OVER (PARTITION BY order_ym)')} AS share FROM (SELECT ym AS order_ym, payment_method, count(*) AS orders FROM t GROUP BY ALL)")
on_t("category_revenue", f"SELECT category, {total()} AS revenue FROM t GROUP BY category")
on_t("top10_categories", f"SELECT category, {total()} AS revenue FROM t GROUP BY category ORDER BY revenue DESC, category LIMIT 10")
_CATEGORY = "s AS (SELECT category, sum(final_amount) AS revenue FROM t GROUP BY category ORDER BY revenue DESC, category LIMIT {n})"
for _name, _n in (("category_share_top10", 10), ("category_share_top6", 6)):
    on_t(_name, f"SELECT category, {d('revenue')} AS revenue, {d('revenue')} / {d('sum(revenue) OVER ()')} AS share FROM s", _CATEGORY.format(n=_n))
on_t("prime_aov", f"SELECT is_prime_member AS is_prime, {total()} AS total, count(final_amount) AS orders, {mean()} AS avg_order_value FROM t GROUP BY 1")
on_t("prime_frequency", f"SELECT is_prime, {mean('n')} AS avg_orders_per_customer FROM (SELECT customer_id, is_prime_member AS is_prime, count(*) AS n FROM t GROUP BY ALL) GROUP BY is_prime")
on_t("prime_category", f"SELECT category, is_prime_member AS is_prime, {total()} AS revenue FROM t GROUP BY ALL".replace("GROUP BY ALL", "GROUP BY category, is_prime_member"))
on_t("state_revenue", f"SELECT customer_state, {total()} AS revenue FROM t GROUP BY customer_state")
on_t("city_revenue", f"SELECT customer_city, {total()} AS revenue FROM t GROUP BY customer_city")
F = """f AS (SELECT 'Diwali' AS festival, year,
    coalesce(sum(final_amount) FILTER (order_date >= a - INTERVAL 14 DAY AND order_date < a), 0) AS revenue_before,
    coalesce(sum(final_amount) FILTER (order_date >= a AND order_date <= a + INTERVAL 7 DAY), 0) AS revenue_during,
    coalesce(sum(final_amount) FILTER (order_date > a + INTERVAL 7 DAY AND order_date <= a + INTERVAL 30 DAY), 0) AS revenue_after
  FROM (SELECT DISTINCT order_year AS year, make_timestamp(order_year, 10, 25, 0, 0, 0) AS a FROM t)
    LEFT JOIN t ON order_date >= a - INTERVAL 14 DAY AND order_date <= a + INTERVAL 30 DAY GROUP BY year)"""
_WINDOWS = ("before", "during", "after")
on_t("festival_windows", "SELECT festival, year, " + ", ".join(f"{d(f'revenue_{w}')} AS revenue_{w}" for w in _WINDOWS) + " FROM f", F)
on_t("unpivot_festival", " UNION ALL ".join(f"SELECT festival, year, 'revenue_{w}' AS period, {d(f'revenue_{w}')} AS revenue FROM f" for w in _WINDOWS), F)
_LABELS = ", ".join(f"('{label}')" for label in AGE_LABELS)
on_t("age_spending", f"""SELECT age_bucket, {total()} AS total, count(final_amount) AS orders, {mean()} AS avg_amount
  FROM (VALUES {_LABELS}) AS b(age_bucket) LEFT JOIN t ON customer_age_group = age_bucket GROUP BY age_bucket""")
PD = "pd AS (SELECT product_id, min(price) AS price, count(*) AS orders, sum(final_amount) AS revenue FROM t GROUP BY product_id)"
on_t("price_demand", f"SELECT product_id, {d('price')} AS price, orders, {d('revenue')} AS revenue FROM pd", PD)


def correlations(source: str, *columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS row_name, '{b}' AS column_name, round(covar_pop({d(a)}, {d(b)}) / nullif(stddev_pop({d(a)}) * stddev_pop({d(b)}), 0), 6) AS correlation FROM {source}"
        for a in columns for b in columns)


on_t("corr_price_demand", correlations("pd", "price", "orders", "revenue"), PD)
on_t("corr_return_rating", correlations("x", "final_amount", "rating", "returned"), "x AS (SELECT final_amount, rating, CAST(return_status = 'R' AS INTEGER) AS returned FROM t)")


def histogram(value: str, bins: int) -> str:
    v = d(value)
    return f"""SELECT CAST(bin AS INTEGER) AS bin, lo + (hi - lo) / {bins} * (bin - 1) AS bin_start, count(v) AS rows
      FROM (SELECT min({v}) AS lo, max({v}) AS hi FROM t) JOIN range(1, {bins + 1}) AS b(bin) ON true
      LEFT JOIN (SELECT {v} AS v FROM t) ON bin = least(CAST(floor({bins} * (v - lo) / (hi - lo)) AS BIGINT) + 1, {bins}) GROUP BY bin, lo, hi"""


on_t("hist_delivery", histogram("delivery_days", 40))
on_t("hist_rating", histogram("rating", 20))
on_t("delivery_on_time", f"SELECT count(delivery_days) AS orders, count(*) FILTER (delivery_days <= 7) AS on_time, avg({d('CAST(delivery_days <= 7 AS INTEGER)')}) AS on_time_share FROM t")
on_t("returns_summary", f"SELECT return_status, count(final_amount) AS orders, {total()} AS revenue FROM t GROUP BY return_status")
on_t("brand_top20", f"SELECT brand, {total()} AS revenue FROM t GROUP BY brand ORDER BY revenue DESC, brand LIMIT 20")
on_t("brand_monthly_top5", f"""SELECT order_ym, s.brand, {total()} AS revenue FROM s JOIN (SELECT DISTINCT ym AS order_ym FROM t JOIN s USING (brand)) ON true
  LEFT JOIN t ON t.brand = s.brand AND ym = order_ym GROUP BY order_ym, s.brand""", "s AS (SELECT brand FROM t GROUP BY brand ORDER BY sum(final_amount) DESC, brand LIMIT 5)")
CO = "co AS (SELECT customer_id, strftime(min(order_date), '%Y-%m') AS cohort_month FROM t GROUP BY customer_id)"
CC = "cc AS (SELECT cohort_month, ym AS order_month, count(DISTINCT customer_id) AS customers FROM t JOIN co USING (customer_id) GROUP BY ALL)"
on_t("cohort_counts", "SELECT * FROM cc", CO, CC)
on_t("cohort_retention", f"""SELECT cohort_month, order_month, customers, cohort_size, {ratio('customers', 'cohort_size')} AS retention
  FROM cc JOIN (SELECT cohort_month, count(*) AS cohort_size FROM co GROUP BY cohort_month) USING (cohort_month)""", CO, CC)
on_t("cohort_clv", f"SELECT cohort_month, {total()} AS revenue, count(DISTINCT customer_id) AS customers, {ratio('sum(final_amount)', 'count(DISTINCT customer_id)')} AS clv FROM t JOIN co USING (customer_id) GROUP BY cohort_month", CO)
_PERCENT = f"{ratio('original_price_inr - final_amount', 'original_price_inr')} * 100"
on_t("discount_full", f"SELECT transaction_id, {d('original_price_inr')} AS original_price_inr, {d('final_amount')} AS final_amount, {_PERCENT} AS disc_pct FROM t")
on_t("discount_trend", f"""SELECT CAST(least(CAST(floor(50 * (x - lo) / (hi - lo)) AS BIGINT) + 1, 50) AS INTEGER) AS bin, count(*) AS rows, {mean('y')} AS mean_value
  FROM (SELECT {_PERCENT} AS x, final_amount AS y, min({_PERCENT}) OVER () AS lo, max({_PERCENT}) OVER () AS hi FROM t) GROUP BY 1""")
on_t("rating_by_product", f"SELECT product_id, {mean('rating')} AS avg_rating, {total()} AS revenue FROM t GROUP BY product_id")
ORACLES["category_transitions_timed"] = """SELECT from_state, to_state, count(*) AS transitions FROM (SELECT event_type AS to_state,
  lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_state FROM events) WHERE from_state IS NOT NULL GROUP BY ALL"""
on_t("category_transitions", """SELECT from_state, to_state, count(*) AS transitions FROM (SELECT category AS to_state,
  lag(category) OVER (PARTITION BY customer_id ORDER BY order_date, transaction_id) AS from_state FROM t) WHERE from_state IS NOT NULL GROUP BY ALL""")
on_t("product_lifecycle", f"""SELECT product_id, strftime(min(order_date), '%Y-%m-%d %H:%M:%S') AS first_sale, strftime(max(order_date), '%Y-%m-%d %H:%M:%S') AS last_sale,
  count(order_date) AS sales_count, {total()} AS revenue, CAST(date_diff('day', min(order_date), max(order_date)) AS INTEGER) AS lifetime_days FROM t GROUP BY product_id""")
on_t("top_product_monthly", f"""SELECT product_id, ym AS order_ym, {total()} AS revenue FROM t
  WHERE product_id IN (SELECT product_id FROM t GROUP BY product_id ORDER BY sum(final_amount) DESC, product_id LIMIT 10) GROUP BY product_id, ym""")
_Q = {"q1": 0.25, "median": 0.5, "q3": 0.75}
on_t("brand_price_box", f"""SELECT brand, rows, q1, median, q3, min(v) FILTER (v BETWEEN lo AND hi) AS whisker_low, max(v) FILTER (v BETWEEN lo AND hi) AS whisker_high,
  count(*) FILTER (NOT v BETWEEN lo AND hi) AS outliers FROM b JOIN (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
  (SELECT brand, count(*) AS rows, {", ".join(f"quantile_cont(v, {p}) AS {n}" for n, p in _Q.items())} FROM b GROUP BY brand)) USING (brand) GROUP BY ALL""",
     f"b AS (SELECT brand, {d('price')} AS v FROM t WHERE brand IN (SELECT brand FROM t GROUP BY brand ORDER BY sum(final_amount) DESC, brand LIMIT 8))")
on_t("kpis", f"""SELECT 'total_revenue' AS metric, {total()} AS value FROM t UNION ALL SELECT 'orders', {d('count(*)')} FROM t
  UNION ALL SELECT 'customers', {d('count(DISTINCT customer_id)')} FROM t UNION ALL SELECT 'avg_order_value', {mean()} FROM t
  UNION ALL SELECT 'yoy_last', max_by(pct_growth, year) / 100 FROM g""", Y, G)
on_t("annual_revenue", f"SELECT year, {d('revenue')} AS revenue FROM y", Y)
on_t("monthly_aov", f"SELECT ym AS order_ym, {mean()} AS avg_order_value FROM t GROUP BY ym")

# --- dashboard -----------------------------------------------------------------------------------


def money_text(x: str) -> str:
    return f"concat('₹', format('{{:,}}', CAST(round_even({d(x)}, 0) AS BIGINT)))"


def executive(where: str, growth: str) -> str:
    return f"""SELECT metric, value, shown FROM (
      SELECT 'total_revenue' AS metric, {total()} AS value, {money_text('sum(final_amount)')} AS shown FROM t {where}
      UNION ALL SELECT 'growth', g, coalesce(format('{{:.1f}}', g * 100) || '%', 'N/A') FROM (SELECT {growth} AS g)
      UNION ALL SELECT 'orders', {d('count(*)')}, format('{{:,}}', count(*)) FROM t {where}
      UNION ALL SELECT 'active_customers', {d('count(DISTINCT customer_id)')}, format('{{:,}}', count(DISTINCT customer_id)) FROM t {where}
      UNION ALL SELECT 'avg_order_value', {mean()}, {money_text(mean())} FROM t {where}
      UNION ALL SELECT 'top_category', NULL, (SELECT category FROM t {where} GROUP BY category ORDER BY sum(final_amount) DESC, category LIMIT 1))"""


_THIS, _LAST = (f"(SELECT sum(final_amount) FROM t WHERE order_year = {y})" for y in (1998, 1997))
on_t("executive_summary", executive("WHERE order_year = 1998", ratio(f"{_THIS} - {_LAST}", _LAST)))
on_t("executive_summary_all", executive("", "CAST(NULL AS DOUBLE)"))
on_t("top_category", f"SELECT category, {total()} AS revenue FROM t GROUP BY category ORDER BY revenue DESC, category LIMIT 1")
M = f"""m AS (SELECT ym AS order_ym, sum(final_amount) AS revenue, count(*) AS orders, count(DISTINCT customer_id) AS active_customers,
    count(DISTINCT dayofmonth(order_date)) AS days_seen FROM t WHERE ym = (SELECT max(ym) FROM t) GROUP BY ym)"""
on_t("month_monitor", f"SELECT order_ym, {d('revenue')} AS revenue, orders, active_customers, days_seen, {ratio('revenue', 'days_seen')} * 30 AS run_rate FROM m", M)
on_t("target_alert", f"SELECT order_ym, {d('revenue')} AS revenue, 5000000.0::DOUBLE AS target, CASE WHEN revenue < 5000000 THEN 'below target' ELSE 'on track' END AS status FROM m", M)
on_t("top_states_by_rows", "SELECT customer_state, count(*) AS orders FROM t GROUP BY customer_state ORDER BY orders DESC, customer_state LIMIT 20")
on_t("festival_monthly_by_name", f"SELECT order_year, order_month, {total()} AS revenue, ym AS order_ym FROM t WHERE order_month IN (3, 10) GROUP BY order_year, order_month, ym")
on_t("price_demand_no_catalog_price", f"SELECT product_id, {mean()} AS price, count(*) AS orders, {total()} AS revenue FROM t GROUP BY product_id")
on_t("canonical_from_csv", f"""SELECT transaction_id, {_STAMP} AS order_date, order_year, order_month, {d('final_amount')} AS final_amount, customer_id, product_id, customer_state,
  payment_method, return_status, CAST(NULL AS VARCHAR) AS rating FROM t""")
on_t("top_states", f"SELECT customer_state, {total()} AS revenue FROM t GROUP BY customer_state ORDER BY revenue DESC, customer_state LIMIT 20")
on_t("monthly_revenue", f"SELECT order_year, order_month, {total()} AS revenue, ym AS order_ym FROM t GROUP BY order_year, order_month, ym")
_X, _YY = d("discount_percent"), d("final_amount")
on_t("ols_discount", f"SELECT round(regr_slope({_YY}, {_X}), 6) AS slope, round(regr_intercept({_YY}, {_X}), 4) AS intercept, round(regr_r2({_YY}, {_X}), 6) AS r2, {big(f'regr_count({_YY}, {_X})')} AS rows FROM t")
on_t("customers_by_year", "SELECT order_year, count(DISTINCT customer_id) AS customers FROM t GROUP BY order_year")
on_t("revenue_series", f"SELECT concat(ym, '-01') AS month_start, {total()} AS revenue FROM t GROUP BY ym")
on_t("category_performance", f"SELECT category, {total()} AS revenue, count(order_date) AS orders FROM t GROUP BY category ORDER BY revenue DESC, category LIMIT 25")
on_t("festival_monthly", f"SELECT order_year, order_month, {total()} AS revenue, ym AS order_ym FROM t WHERE is_festival_sale GROUP BY order_year, order_month, ym")
on_t("price_optimization", f"SELECT product_id, {mean('original_price_inr')} AS price, count(order_date) AS orders, {total()} AS revenue FROM t GROUP BY product_id")


def described(source: str, column: str) -> str:
    v = d(column)
    quartiles = ", ".join(f"round(quantile_cont({v}, {p}), 4) AS {n}" for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
    return f"SELECT '{column}' AS column_name, count({column}) AS count, {mean(column)} AS mean, round(stddev_samp({v}), 4) AS std, min({v}) AS min, {quartiles}, max({v}) AS max FROM {source}"


on_t("describe_rfm", " UNION ALL ".join(described("rfm", c) for c in ("recency", "frequency", "monetary")), RFM)
on_t("describe_rating", described("t", "rating"))
on_t("age_group_spending", f"SELECT customer_age_group, {total()} AS total, {mean()} AS avg_amount, count(final_amount) AS orders FROM t WHERE customer_age_group IS NOT NULL GROUP BY customer_age_group")
on_t("top_products", f"SELECT product_id, count(order_date) AS units, {total()} AS revenue FROM t GROUP BY product_id ORDER BY revenue DESC, product_id LIMIT 50")
on_t("payment_counts", "SELECT payment_method AS method, count(*) AS orders FROM t GROUP BY payment_method ORDER BY orders DESC, method LIMIT 20")
on_t("return_counts", "SELECT return_status AS status, count(*) AS orders FROM t GROUP BY return_status")
