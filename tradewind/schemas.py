"""Schemas of the star schema and of the analytics frame."""

from __future__ import annotations

from pyspark.sql import types as T

_FIELDS = {
    "customers": """
        customer_id STRING NOT NULL, customer_city STRING, customer_state STRING, customer_tier STRING,
        customer_spending_tier STRING, customer_age_group STRING, is_prime_member BOOLEAN,
        lifetime_value DECIMAL(14,2), total_orders INT, avg_order_value DECIMAL(12,2)""",
    "products": """
        product_id STRING NOT NULL, product_name STRING, category STRING, subcategory STRING, brand STRING,
        base_price_2015 DECIMAL(12,2), weight_kg DECIMAL(8,3), rating DECIMAL(3,1), is_prime_eligible BOOLEAN,
        launch_year SMALLINT, model STRING, price DECIMAL(12,2)""",
    "time_dimension": """
        date_id DATE NOT NULL, year SMALLINT, quarter TINYINT, month TINYINT, month_name STRING,
        week_of_year TINYINT, day_of_month TINYINT, day_name STRING, is_weekend BOOLEAN""",
    "transactions": """
        transaction_id STRING NOT NULL, order_date TIMESTAMP_NTZ NOT NULL, customer_id STRING NOT NULL,
        product_id STRING NOT NULL, product_name STRING, category STRING, subcategory STRING, brand STRING,
        original_price_inr DECIMAL(12,2), discount_percent DECIMAL(5,2), discounted_price_inr DECIMAL(12,2),
        quantity INT, subtotal_inr DECIMAL(12,2), delivery_charges DECIMAL(10,2), final_amount_inr DECIMAL(12,2),
        customer_city STRING, customer_state STRING, customer_tier STRING, customer_spending_tier STRING,
        customer_age_group STRING, payment_method STRING, delivery_days TINYINT, delivery_type STRING,
        is_prime_member BOOLEAN, is_festival_sale BOOLEAN, festival_name STRING, customer_rating DECIMAL(3,1),
        return_status STRING, order_month TINYINT, order_year SMALLINT, order_quarter TINYINT,
        product_weight_kg DECIMAL(8,3), is_prime_eligible BOOLEAN, product_rating DECIMAL(3,1),
        final_amount DECIMAL(12,2), original_price_inr_clean DECIMAL(12,2)""",
}


def warehouse_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(_FIELDS[table])


def warehouse_tables() -> list[str]:
    return list(_FIELDS)
