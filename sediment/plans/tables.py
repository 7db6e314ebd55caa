"""The silver and gold tables and which columns an upsert overwrites (fixed values)."""

from __future__ import annotations

from sediment import schemas
from sediment.operators.upsert import MergeSpec
from sediment.sinks.tables import Partitioning, TableSpec

# Folders of the dimension tables.
BUCKETS = 32

# Columns that are not listed keep the value of the first insert.
CUSTOMERS = TableSpec(
    "customers",
    schemas.SILVER_CUSTOMERS,
    MergeSpec("customer_id", ("name", "email", "country", "updated_at")),
    Partitioning.by_key("customer_bucket", BUCKETS),
)
PRODUCTS = TableSpec(
    "products",
    schemas.SILVER_PRODUCTS,
    MergeSpec("product_id", ("name", "category", "price", "inventory_count", "updated_at")),
    Partitioning.by_key("product_bucket", BUCKETS),
)
ORDERS = TableSpec(
    "orders",
    schemas.SILVER_ORDERS,
    MergeSpec("order_id", ("total_amount", "status", "updated_at")),
    Partitioning("order_day"),  # day of order_date
    "days(order_date)",
)
ORDER_ITEMS = TableSpec(
    "order_items",
    schemas.SILVER_ORDER_ITEMS,
    MergeSpec("order_item_id", ("quantity", "unit_price", "updated_at")),
    Partitioning("landed_day"),  # run date of the first delivery
)
GOLD_DAILY_SALES = TableSpec(
    "gold_daily_sales",
    schemas.GOLD_DAILY_SALES,
    MergeSpec(
        "order_date",
        ("total_revenue", "orders_count", "average_order_value", "cancelled_orders_count", "updated_at"),
    ),
)
GOLD_CUSTOMER_METRICS = TableSpec(
    "gold_customer_metrics",
    schemas.GOLD_CUSTOMER_METRICS,
    MergeSpec(
        "customer_id",
        (
            "customer_name",
            "email",
            "country",
            "total_orders",
            "total_spent",
            "first_order_date",
            "last_order_date",
            "updated_at",
        ),
    ),
)
GOLD_CATEGORY_PERFORMANCE = TableSpec(
    "gold_category_performance",
    schemas.GOLD_CATEGORY_PERFORMANCE,
    MergeSpec("category", ("units_sold", "revenue_generated", "updated_at")),
)

# What gold is computed from when it takes changes (see sediment.operators.parts).
DAILY_PARTS = TableSpec("gold_daily_parts", schemas.DAILY_PARTS, MergeSpec("order_date", ()))
CUSTOMER_PARTS = TableSpec("gold_customer_parts", schemas.CUSTOMER_PARTS, MergeSpec("customer_id", ()))
PRODUCT_PARTS = TableSpec("gold_product_parts", schemas.PRODUCT_PARTS, MergeSpec("product_id", ()))

SILVER = (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS)
GOLD = (GOLD_DAILY_SALES, GOLD_CUSTOMER_METRICS, GOLD_CATEGORY_PERFORMANCE)
