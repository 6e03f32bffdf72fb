"""Column functions: ``Column -> Column``, all evaluated inside the JVM."""

from .naming import (
    age_bucket,
    ascii_header,
    clean_brand,
    clean_category,
    clean_city,
    clean_payment,
    clean_product_id,
    clean_product_name,
    format_currency,
    format_percent,
    snake_header,
    title_case,
    year_month,
    year_month_label,
)
from .parsing import (
    blank_to_null,
    clean_bool,
    clean_date,
    clean_delivery_days,
    clean_price,
    clean_rating,
    coerce_int,
    flag_from_text,
    iso_date,
    lenient_flag,
    null_tokens,
    parse_flag,
    strip_numeric,
    to_decimal,
    to_number,
)
