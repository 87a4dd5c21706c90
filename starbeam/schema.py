"""Column names and types of the order-line record and the star tables."""

from __future__ import annotations

from pyspark.sql import types as T

# the 21 source columns, in the record's own order, with the CSV header each comes from
SOURCE_HEADERS = {
    "Row ID": "row_id",
    "Order ID": "order_id",
    "Order Date": "order_date",
    "Ship Date": "ship_date",
    "Ship Mode": "ship_mode",
    "Customer ID": "customer_id",
    "Customer Name": "customer_name",
    "Segment": "segment",
    "Country": "country",
    "City": "city",
    "State": "state",
    "Postal Code": "postal_code",
    "Region": "region",
    "Product ID": "product_id",
    "Category": "category",
    "Sub-Category": "sub_category",
    "Product Name": "product_name",
    "Sales": "sales",
    "Quantity": "quantity",
    "Discount": "discount",
    "Profit": "profit",
}
SOURCE_COLUMNS = list(SOURCE_HEADERS.values())
TEXT_COLUMNS = [c for c in SOURCE_COLUMNS if c not in ("row_id", "sales", "quantity", "discount", "profit")]
KEY_COLUMNS = ["order_date", "ship_date", "customer_id", "product_id"]

MONEY = T.DecimalType(12, 4)
RATE = T.DecimalType(5, 4)

FACT_COLUMNS = [
    "order_line_key", "row_id", "order_id", "order_date_key", "ship_date_key", "ship_mode_key",
    "customer_key", "geography_key", "product_key", "sales", "quantity", "discount", "profit",
    "revenue_after_discount",
]

# NOT NULL columns per star table (schema of the warehouse)
NOT_NULL = {
    "dim_date": ["date_key", "full_date", "day", "month", "quarter", "year", "day_of_week", "day_name",
                 "month_name", "is_weekend"],
    "dim_customer": ["customer_key", "customer_id", "customer_name", "segment"],
    "dim_geography": ["geography_key", "city", "state", "country", "region"],
    "dim_product": ["product_key", "product_id", "product_name", "category", "sub_category"],
    "dim_ship_mode": ["ship_mode_key", "ship_mode"],
    "fact_orders": ["order_line_key", "row_id", "order_id", "order_date_key", "ship_date_key", "ship_mode_key",
                    "customer_key", "geography_key", "product_key", "sales", "quantity", "discount", "profit"],
    "dim_product_recommendations": ["recommendation_key", "product_key", "recommended_product_key", "date_key",
                                    "recommendation_type", "recommendation_score"],
}

# natural / unique keys per star table
UNIQUE_KEYS = {
    "dim_date": [["date_key"], ["full_date"]],
    "dim_customer": [["customer_key"], ["customer_id"]],
    "dim_geography": [["geography_key"], ["postal_code", "city", "state"]],
    "dim_product": [["product_key"], ["product_id"]],
    "dim_ship_mode": [["ship_mode_key"], ["ship_mode"]],
    "fact_orders": [["order_line_key"], ["row_id"]],
    "dim_product_recommendations": [
        ["recommendation_key"],
        ["product_key", "recommended_product_key", "date_key", "recommendation_type"],
    ],
}

# VARCHAR length limits of the warehouse schema.
MAX_LENGTHS = {
    "dim_date": {"day_name": 10, "month_name": 10},
    "dim_customer": {"customer_id": 20, "customer_name": 100, "segment": 50},
    "dim_geography": {"postal_code": 10, "city": 100, "state": 100, "country": 100, "region": 50},
    "dim_product": {"product_id": 50, "category": 50, "sub_category": 50},
    "dim_ship_mode": {"ship_mode": 50},
    "fact_orders": {"order_id": 20},
    "dim_product_recommendations": {"recommendation_type": 50},
}

# (fact column, dimension table, dimension key)
FOREIGN_KEYS = [
    ("order_date_key", "dim_date", "date_key"),
    ("ship_date_key", "dim_date", "date_key"),
    ("ship_mode_key", "dim_ship_mode", "ship_mode_key"),
    ("customer_key", "dim_customer", "customer_key"),
    ("geography_key", "dim_geography", "geography_key"),
    ("product_key", "dim_product", "product_key"),
]

RECOMMENDATION_SCHEMA = T.StructType([
    T.StructField("source_product_id", T.StringType()),
    T.StructField("recommended_product_id", T.StringType()),
    T.StructField("recommendation_type", T.StringType()),
    T.StructField("recommendation_score", RATE),
    T.StructField("recommendation_reason", T.StringType()),
])
