"""Gold as mergeable parts: sums and counts per group that take signed changes.

A gold row is computed from a row of parts, and parts of the same group add up, also with
negative signs. So after an upsert only its images (rows as they were, sign -1, and as they are,
sign 1) are aggregated and added to the stored parts; the silver tables are not read again.

Two things cannot be taken back by adding: the earliest and latest date of a group, and an
amount that is not whole cents, which is held in a double sum. Groups that lose such a value
(`stale` in the functions below) are computed anew from their own silver rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.functions.money import split, split_line, total
from sediment.operators.gold import CANCELLED
from sediment.operators.keys import quoted

MONEY = ("high", "middle", "low", "rest", "cents", "rests")


def _signed(value: Column, sign: Column) -> Column:
    return F.sum(F.coalesce(value * sign, F.lit(0)))


def _money(parts: Sequence[Column], sign: Column) -> list[Column]:
    """Signed sums of the money parts, and how many amounts are whole cents and how many are not."""
    high, middle, low, rest = parts
    sums = [_signed(part, sign).alias(name) for part, name in zip((high, middle, low, rest), MONEY)]
    numbers = [F.sum(F.when(part.isNotNull(), sign).otherwise(0)) for part in (low, rest)]
    return [*sums, *[number.alias(name) for number, name in zip(numbers, MONEY[4:])]]


def _amount() -> Column:
    """The summed amount of a row of parts; NULL where there was none."""
    has_cents, has_rest = F.col("cents") > 0, F.col("rests") > 0
    whole = [F.when(has_cents, F.col(name)) for name in MONEY[:3]]
    return total(*whole, F.when(has_rest, F.col("rest")))


def daily_parts(orders: DataFrame, sign: str | None = None) -> DataFrame:
    by = F.col(sign) if sign else F.lit(1)
    return orders.groupBy(F.to_date("order_date").alias("order_date")).agg(
        *_money(split(F.col("total_amount")), by),
        F.sum(F.when(F.col("order_id").isNotNull(), by).otherwise(0)).alias("orders_count"),
        F.sum(F.when(F.col("status") == CANCELLED, by).otherwise(0)).alias("cancelled"),
        F.sum(by).alias("held"),
    )


def customer_parts(orders: DataFrame, sign: str | None = None) -> DataFrame:
    by = F.col(sign) if sign else F.lit(1)
    added = F.when(by > 0, F.col("order_date"))
    return orders.filter("customer_id is not null").groupBy("customer_id").agg(
        *_money(split(F.col("total_amount")), by),
        F.sum(F.when(F.col("order_id").isNotNull(), by).otherwise(0)).alias("total_orders"),
        F.min(added).alias("first_order_date"),
        F.max(added).alias("last_order_date"),
        F.sum(by).alias("held"),
    )


def product_parts(order_items: DataFrame, sign: str | None = None) -> DataFrame:
    by = F.col(sign) if sign else F.lit(1)
    return order_items.filter("product_id is not null").groupBy("product_id").agg(
        *_money(split_line(F.col("quantity"), F.col("unit_price")), by),
        _signed(F.col("quantity"), by).alias("units"),
        F.sum(F.when(F.col("quantity").isNotNull(), by).otherwise(0)).alias("quantities"),
        F.sum(by).alias("held"),
    )


def rest_removed(images: DataFrame, key: Column, name: str, parts: Sequence[Column], sign: str) -> DataFrame:
    """Groups that lose an amount that is not whole cents."""
    return images.filter((F.col(sign) < 0) & parts[3].isNotNull()).select(key.alias(name)).distinct()


def date_removed(images: DataFrame, stored: DataFrame, sign: str) -> DataFrame:
    """Customers that lose the last order of their earliest or latest date.

    Only dates that lose any order are added up; a run that takes none away shuffles no image.
    """
    lost = images.filter(F.col(sign) < 0).select("customer_id", "order_date").distinct()
    touched = images.join(lost, ["customer_id", "order_date"], "left_semi")
    net = touched.groupBy("customer_id", "order_date").agg(F.sum(sign).alias("net")).filter("net < 0")
    edge = stored.select("customer_id", "first_order_date", "last_order_date")
    at_edge = (F.col("order_date") <= F.col("first_order_date")) | (F.col("order_date") >= F.col("last_order_date"))
    return net.join(edge, "customer_id").filter(at_edge).select("customer_id").distinct()


def merged(stored: DataFrame, delta: DataFrame, key: str, anew: DataFrame | None = None) -> DataFrame:
    """The stored parts with the delta added; groups without rows go. Groups of `anew` are
    replaced by it."""
    smallest, largest = {"first_order_date"}, {"last_order_date"}

    def added(name: str) -> Column:
        function = F.min if name in smallest else F.max if name in largest else F.sum
        return function(F.col(quoted(name))).alias(name)

    names = [name for name in stored.columns if name != key]
    both = stored.select(key, *names).unionAll(delta.select(key, *names))
    result = both.groupBy(key).agg(*[added(name) for name in names]).filter("held > 0")
    result = result.select(stored.columns)
    if anew is None:
        return result
    replaced = anew.select(F.col(key).alias("replaced"))
    kept = result.join(replaced, F.col(key).eqNullSafe(F.col("replaced")), "left_anti")
    return kept.select(stored.columns).unionAll(anew.filter("held > 0").select(stored.columns))


def daily_sales(parts: DataFrame) -> DataFrame:
    revenue = _amount()
    return parts.select(
        "order_date",
        revenue.alias("total_revenue"),
        "orders_count",
        F.try_divide(revenue, F.col("cents") + F.col("rests")).alias("average_order_value"),
        F.col("cancelled").alias("cancelled_orders_count"),
    )


def customer_metrics(parts: DataFrame, customers: DataFrame) -> DataFrame:
    spent = parts.withColumn("total_spent", _amount())
    return spent.join(customers, "customer_id").select(
        "customer_id",
        F.col("name").alias("customer_name"),
        "email",
        "country",
        "total_orders",
        "total_spent",
        "first_order_date",
        "last_order_date",
    )


def category_performance(parts: DataFrame, products: DataFrame) -> DataFrame:
    grouped = (
        parts.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(*[F.sum(name).alias(name) for name in (*MONEY, "units", "quantities")])
    )
    return grouped.select(
        "category",
        F.when(F.col("quantities") > 0, F.col("units")).alias("units_sold"),
        _amount().alias("revenue_generated"),
    )
