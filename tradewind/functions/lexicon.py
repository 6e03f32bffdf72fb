"""Word lists, tables and formats that decide results. Order matters in all of them."""

# --- fixed values -----------------------------------------------------------------------------

# Text that stands for a missing value in CSV input.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Shapes of dates in figures, parted by hyphens, slashes or dots (yyyy-m-d, d/m/yyyy, d.m.yy, yyyymmdd), and their ISO order.
FIGURE_DATES = {
    r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})$": "$1-$3-$4",
    r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4})$": "$4-$3-$1",
    r"^(\d{4})(\d{2})(\d{2})$": "$1-$2-$3",
}
SHORT_FIGURE_DATE = r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{2})$"
SHORT_FIGURE_ISO = "20$4-$3-$1"
# Formats of dates with a month name, by shape.
WORD_DATE_FORMATS = {
    r"^\d{1,2} [A-Za-z]+ \d{4}$": ["d MMM yyyy", "d MMMM yyyy"],
    r"^[A-Za-z]+ \d{1,2} \d{4}$": ["MMM d yyyy", "MMMM d yyyy"],
    r"^\d{4} [A-Za-z]+ \d{1,2}$": ["yyyy MMM d", "yyyy MMMM d"],
}
SHORT_WORD_DATE = r"^\d{1,2} [A-Za-z]+ \d{2}$"
SHORT_WORD_FORMATS = ["d MMM yy", "d MMMM yy"]
# What may stand around a date: the name of the day before it, the time of day after it.
WEEKDAY = r"(?i)^(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?\b[.,]?\s*"
TIME_OF_DAY = r"(?i)[\sT,]+(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?(?:\s*[ap]\.?m\.?)?$"
DATE_SEPARATORS = r"[\s,.\-/]+"
SEPTEMBER = r"(?i)\bsept\b"
# "5th of June 2018" is read like "5 June 2018".
ORDINAL = r"(?i)(\d)(?:st|nd|rd|th)\b(?:\s+of\b)?"
ISO_DATE_TIME = r"^\d{4}-\d{1,2}-\d{1,2}[T ]"
LAST_TWO_DIGIT_YEAR = 2068

# Price text.
PLAIN_NUMBER = r"^[0-9]+(?:\.[0-9]+)?$"
PRICE_ABSENT = r"(?i)price\s*on\s*request|not\s*available|\bna\b"
CURRENCY_PREFIX = r"(?i)^\s*(₹|rs\.?|inr)\s*"
PRICE_UNIT = r"(?i)([0-9]+(?:\.[0-9]+)?)\s*(lakh|lac|crore|cr|k|million|m|billion)\b"
PRICE_UNITS = {
    "lakh": 1e5, "lac": 1e5, "crore": 1e7, "cr": 1e7, "k": 1e3, "m": 1e6, "million": 1e6, "billion": 1e9,
}

# Rating text.
RATING_FRACTION = r"([0-9]+(?:\.[0-9]+)?)\s*/\s*([0-9]+(?:\.[0-9]+)?)"
RATING_NUMBER = r"([0-9]+(?:\.[0-9]+)?)"

# City aliases.
CITY_ALIASES = {
    "bangalore": "Bengaluru", "bengaluru": "Bengaluru", "blr": "Bengaluru",
    "mumbai": "Mumbai", "bombay": "Mumbai", "mum": "Mumbai",
    "delhi": "New Delhi", "new delhi": "New Delhi", "ncr": "New Delhi",
    "chennai": "Chennai", "madras": "Chennai", "kolkata": "Kolkata", "calcutta": "Kolkata",
    "pune": "Pune", "hyderabad": "Hyderabad", "ahmedabad": "Ahmedabad",
    "gurgaon": "Gurugram", "gurugram": "Gurugram", "noida": "Noida",
}
MISSING_WORDS = ["", "nan", "none", "na"]

# Product category synonyms.
CATEGORY_SYNONYMS = {
    "electronics": "Electronics", "electronic": "Electronics", "electronics & accessories": "Electronics",
    "mobiles": "Mobiles & Accessories", "mobile": "Mobiles & Accessories",
    "fashion": "Fashion", "clothing": "Fashion",
    "home & kitchen": "Home & Kitchen", "home & living": "Home & Kitchen",
    "books": "Books", "beauty & personal care": "Beauty & Personal Care",
}

# Payment keywords; the first group with a match wins.
PAYMENT_GROUPS = {
    "UPI": ["upi", "gpay", "google pay", "phonepe", "paytm", "bhim", "tez", "googlepay"],
    "COD": ["cash on delivery", "cod", "c o d"],
    "Credit Card": ["credit card", "creditcard", r"\bcc\b", "visa", "mastercard", "amex"],
    "Debit Card": ["debit card", "debitcard"],
    "NetBanking": ["netbank", "net banking", "netbanking", "internet banking", "bank transfer", "neft", "rtgs"],
    "Wallet": ["wallet", "paytm wallet", "mobikwik"],
}

# Flag words.
TRUE_WORDS = ["1", "true", "yes", "y", "t", "1.0"]
FALSE_WORDS = ["0", "false", "no", "n", "f", "0.0"]
LENIENT_TRUE_WORDS = ["true", "1", "yes", "y", "t"]
RETURNED_WORDS = ["1", "true", "yes", "y", "t", "returned", "r"]

# Delivery days outside this range are not believed.
MAX_DELIVERY_DAYS = 30
ON_TIME_DAYS = 7

# Age buckets, closed on the right.
AGE_EDGES = [0, 18, 25, 35, 45, 55, 65, 200]
AGE_LABELS = ["<18", "18-24", "25-34", "35-44", "45-54", "55-64", "65+"]

# Price repair: suspicious from 50 times the median; divisors tried in turn; accepted range.
OUTLIER_FACTOR = 50
REPAIR_DIVISORS = [10, 100, 1000]
REPAIR_LOW, REPAIR_HIGH = 0.5, 5
CATALOG_OUTLIER_FACTOR = 100

# Festival windows in days around the anchor, 25 October where no calendar is given.
FESTIVAL_MONTH_DAY = (10, 25)
FESTIVAL_BEFORE, FESTIVAL_DURING, FESTIVAL_AFTER = 14, 7, 30

# Column names looked for, in order of preference.
RAW_PRICE_NAMES = ["original_price_inr", "original_price", "price", "list_price"]
RAW_QUANTITY_NAMES = ["quantity", "qty", "order_quantity"]
RAW_PAYMENT_NAMES = ["payment_method", "payment", "paymethod", "mode_of_payment", "pay_type"]
RAW_ID_NAMES = ["product_id", "sku", "asin", "id"]
CATALOG_PRICE_NAMES = ["mrp", "price", "list_price", "selling_price", "original_price"]
DUPLICATE_KEY = ["customer_id", "product_id", "order_date", "final_amount"]
CUSTOMER_ATTRIBUTES = [
    "customer_city", "customer_state", "customer_tier", "customer_spending_tier", "customer_age_group",
    "is_prime_member",
]
CUSTOMER_AMOUNT_NAMES = ["final_amount_inr", "final_amount", "final_amount_inr_clean"]
TRANSACTION_NUMERIC = [
    "original_price_inr", "discount_percent", "discounted_price_inr", "quantity", "subtotal_inr",
    "delivery_charges", "final_amount_inr", "product_weight_kg", "product_rating", "customer_rating",
    "final_amount", "original_price_inr_clean",
]
TRANSACTION_INTEGERS = ["order_month", "order_quarter", "order_year", "delivery_days", "quantity"]
PRODUCT_NUMERIC = ["base_price_2015", "weight_kg", "rating", "price"]
CANONICAL_NAMES = {
    "transaction_id": ["transaction_id"],
    "order_date": ["order_date", "orderdate", "order_date_time", "order_timestamp", "date"],
    "order_year": ["order_year", "year", "order_yr"],
    "order_month": ["order_month", "month", "order_mo"],
    "final_amount": [
        "final_amount", "final_amount_inr", "final_price", "order_value", "amount", "total_amount", "price",
    ],
    "product_id": ["product_id", "product_name"],
    "product_name": ["product_name"],
    "category": ["category", "product_category", "category_name", "cat"],
    "customer_city": ["customer_city", "city", "ship_city"],
    "customer_state": ["customer_state", "state", "ship_state"],
    "customer_id": ["customer_id"],
    "delivery_days": ["delivery_days", "delivery_time_days"],
    "is_prime_member": ["is_prime_member", "is_prime", "prime"],
    "rating": ["product_rating", "customer_rating", "rating"],
    "return_status": ["return_status", "is_returned", "returned"],
    "payment_method": ["payment_method"],
    "discount_percent": ["discount_percent"],
    "is_festival_sale": ["is_festival_sale"],
    "festival_name": ["festival_name"],
    "customer_age_group": ["customer_age_group"],
    "original_price_inr": ["original_price_inr", "original_price_inr_clean", "price", "base_price_2015"],
    "quantity": ["quantity"],
    "brand": ["brand"],
}
