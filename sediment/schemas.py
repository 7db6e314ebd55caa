"""Column lists of the landing feeds and of the silver and gold tables (fixed values)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


def _columns(**types: str) -> StructType:
    """A schema of nullable columns; needs no running session, unlike parsing DDL text."""
    schema = StructType()
    for name, data_type in types.items():
        schema = schema.add(name, data_type)
    return schema


# Landing feeds: JSON objects, timestamps as text.
BRONZE_CUSTOMERS = _columns(
    customer_id="string",
    name="string",
    email="string",
    country="string",
    signup_date="string",
    updated_at="string",
)
BRONZE_PRODUCTS = _columns(
    product_id="string",
    name="string",
    category="string",
    price="double",
    inventory_count="integer",
    updated_at="string",
)
BRONZE_ORDERS = _columns(
    order_id="string",
    customer_id="string",
    order_date="string",
    total_amount="double",
    status="string",
    updated_at="string",
)
BRONZE_ORDER_ITEMS = _columns(
    order_item_id="string",
    order_id="string",
    product_id="string",
    quantity="integer",
    unit_price="double",
    updated_at="string",
)

SILVER_CUSTOMERS = _columns(
    customer_id="string",
    name="string",
    email="string",
    country="string",
    signup_date="timestamp",
    updated_at="timestamp",
)
SILVER_PRODUCTS = _columns(
    product_id="string",
    name="string",
    category="string",
    price="double",
    inventory_count="integer",
    updated_at="timestamp",
)
SILVER_ORDERS = _columns(
    order_id="string",
    customer_id="string",
    order_date="timestamp",
    total_amount="double",
    status="string",
    updated_at="timestamp",
)
SILVER_ORDER_ITEMS = _columns(
    order_item_id="string",
    order_id="string",
    product_id="string",
    quantity="integer",
    unit_price="double",
    updated_at="timestamp",
)
SILVER_PRICES = _columns(
    coin_id="string",
    price_usd="double",
    market_cap_usd="double",
    volume_24h_usd="double",
    change_24h_percent="double",
    timestamp="timestamp",
)

GOLD_DAILY_SALES = _columns(
    order_date="date",
    total_revenue="double",
    orders_count="long",
    average_order_value="double",
    cancelled_orders_count="long",
    updated_at="timestamp",
)
GOLD_CUSTOMER_METRICS = _columns(
    customer_id="string",
    customer_name="string",
    email="string",
    country="string",
    total_orders="long",
    total_spent="double",
    first_order_date="timestamp",
    last_order_date="timestamp",
    updated_at="timestamp",
)
GOLD_CATEGORY_PERFORMANCE = _columns(
    category="string",
    units_sold="long",
    revenue_generated="double",
    updated_at="timestamp",
)

_MONEY_PARTS = {"high": "long", "middle": "long", "low": "long", "rest": "double", "cents": "long", "rests": "long"}
DAILY_PARTS = _columns(order_date="date", **_MONEY_PARTS, orders_count="long", cancelled="long", held="long")
CUSTOMER_PARTS = _columns(
    customer_id="string",
    **_MONEY_PARTS,
    total_orders="long",
    first_order_date="timestamp",
    last_order_date="timestamp",
    held="long",
)
PRODUCT_PARTS = _columns(product_id="string", **_MONEY_PARTS, units="long", quantities="long", held="long")


@dataclass(frozen=True)
class Feed:
    """A landing feed: where it lies, its columns, which of them are timestamps in text."""

    path: str
    schema: StructType
    timestamps: tuple[str, ...]
    daily: bool  # one folder per day, or one snapshot replaced each time


CUSTOMERS_FEED = Feed("customers/customers.json", BRONZE_CUSTOMERS, ("signup_date", "updated_at"), False)
PRODUCTS_FEED = Feed("products/products.json", BRONZE_PRODUCTS, ("updated_at",), False)
ORDERS_FEED = Feed("orders", BRONZE_ORDERS, ("order_date", "updated_at"), True)
ORDER_ITEMS_FEED = Feed("order_items", BRONZE_ORDER_ITEMS, ("updated_at",), True)
