"""Names, column contracts and rules shared by every layer."""

from __future__ import annotations

# Exact money type: 29 integer digits and 9 decimals, so no input cent is rounded away.
NUMERIC = "decimal(38,9)"

RAW_TABLES = ("orders", "order_items", "customers", "sellers")

# The raw columns the pipeline reads. Files may hold more.
RAW_COLUMNS = {
    "orders": (
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "order_items": (
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "price",
        "freight_value",
    ),
    "customers": ("customer_id", "customer_state"),
    "sellers": ("seller_id", "seller_state"),
}

FACT = "fct_delivery_performance"
FACT_OPT = "fct_delivery_performance_opt"
DIM_SELLER = "dim_seller"
PARTITION_KEY = "order_month"
CLUSTER_KEYS = ("seller_state", "seller_id")

FACT_COLUMNS = (
    "order_id",
    "order_date",
    "order_month",
    "seller_id",
    "seller_state",
    "customer_state",
    "delivered_date",
    "estimated_date",
    "late_days",
    "is_late",
    "delivery_days",
    "item_count",
    "order_value",
    "freight_value",
)

DELIVERED = "delivered"
LEADERBOARD_FLOOR = 20  # fewer delivered orders than this make a seller's rate noise
MAX_DELIVERY_DAYS = 365
EXPECTED_STATES = 27
RATE_TOLERANCE = 0.00005  # half of the last digit shown in a 4-decimal rate
PCT_TOLERANCE = 0.01
COUNTRY_PREFIX = "BR-"
COUNTRY_SUFFIX = ", Brazil"
REGION_CODE_PATTERN = r"^BR-[A-Z]{2}\z"
