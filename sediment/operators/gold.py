"""Gold aggregates over the silver tables."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.functions.money import partial_sums, split_line, sum_money, total

# Fixed value: the order status that counts as a cancellation.
CANCELLED = "Cancelled"


def stamped(df: DataFrame, run_ts: datetime.datetime | Column | None) -> DataFrame:
    """Add the run's timestamp as `updated_at`; leave the frame alone if none is given."""
    if run_ts is None:
        return df
    return df.withColumn("updated_at", F.lit(run_ts))


def daily_sales(orders: DataFrame, run_ts: datetime.datetime | Column | None = None) -> DataFrame:
    """One row per calendar day of `order_date`, cancelled orders included in the revenue."""
    amount = F.col("total_amount")
    per_day = orders.groupBy(F.to_date("order_date").alias("order_date")).agg(
        sum_money(amount).alias("total_revenue"),
        F.count("order_id").alias("orders_count"),
        F.count(amount).alias("amounts"),
        F.count_if(F.col("status") == CANCELLED).alias("cancelled_orders_count"),
    )
    result = per_day.select(
        "order_date",
        "total_revenue",
        "orders_count",
        F.try_divide("total_revenue", "amounts").alias("average_order_value"),
        "cancelled_orders_count",
    )
    return stamped(result, run_ts)


def customer_metrics(
    orders: DataFrame, customers: DataFrame, run_ts: datetime.datetime | Column | None = None
) -> DataFrame:
    """One row per known customer with orders.

    Orders are aggregated before the join: a customer holding a large share of all orders
    shrinks to one row per map task before anything is shuffled.
    """
    per_customer = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        sum_money(F.col("total_amount")).alias("total_spent"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    result = per_customer.join(customers, "customer_id").select(
        "customer_id",
        F.col("name").alias("customer_name"),
        "email",
        "country",
        "total_orders",
        "total_spent",
        "first_order_date",
        "last_order_date",
    )
    return stamped(result, run_ts)


def category_performance(
    order_items: DataFrame, products: DataFrame, run_ts: datetime.datetime | Column | None = None
) -> DataFrame:
    """Units and revenue per product category.

    The sums are additive, so the items are reduced to one row per product first: a best
    seller shrinks on the map side, and the join and the category step see one row per product.
    """
    parts = ("high", "middle", "low", "rest")
    sums = partial_sums(*split_line(F.col("quantity"), F.col("unit_price")))
    per_product = order_items.groupBy("product_id").agg(
        F.sum("quantity").alias("units"), *[own.alias(part) for own, part in zip(sums, parts)]
    )
    result = (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            F.sum("units").alias("units_sold"),
            total(*partial_sums(*map(F.col, parts))).alias("revenue_generated"),
        )
    )
    return stamped(result, run_ts)
