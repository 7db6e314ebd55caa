"""Upserts. History up to 2000 is the target, a feed since 1998 the source, so that some rows
lie only in the target, some in both and some only in the source; dimensions overlap by
segment or category instead. Columns that a match must keep differ in the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.operators import gold
from sediment.operators.upsert import MergePlan, merge_upsert
from sediment.plans import tables
from sediment.queries import shapes
from sediment.sinks.staging import staged
from sediment.sources import conform


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _history(df: DataFrame, day: str) -> DataFrame:
    return df.filter(F.col(day) < at("2000-01-01"))


def _feed(df: DataFrame, day: str) -> DataFrame:
    return df.filter(F.col(day) >= at("1998-01-01"))



OLD, NEW = "2024-01-01 00:00:00", "2026-06-10 00:00:00"


def merge_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = conform.customers(spark, sf_dir)
    target = known.filter("segment <> 'BUILDING'").drop("segment")
    source = known.filter("segment <> 'MACHINERY'").drop("segment")
    return merge_upsert(
        target.withColumns({"signup_date": at(OLD), "updated_at": at(OLD)}),
        source.withColumns(
            {
                "country": F.concat(F.lit("NEW "), "country"),
                "email": F.concat(F.lit("new."), "email"),
                "signup_date": at(NEW),
                "updated_at": at(NEW),
            }
        ),
        tables.CUSTOMERS.merge,
        MergePlan.ONE_PASS,
    )


def merge_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = conform.products(spark, sf_dir)
    return merge_upsert(
        catalog.filter("category <> 'PROMO'").withColumn("updated_at", at(OLD)),
        catalog.filter("category <> 'ECONOMY'").withColumns(
            {
                "price": F.col("price") + 1,
                "inventory_count": F.col("inventory_count") + 5,
                "category": F.lower("category"),
                "updated_at": at(NEW),
            }
        ),
        tables.PRODUCTS.merge,
        MergePlan.ONE_PASS,
    )


def merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = conform.orders(spark, sf_dir)
    return merge_upsert(
        _history(orders, "order_date").withColumn("updated_at", at(OLD)),
        _feed(orders, "order_date").withColumns(
            {
                "customer_id": F.col("customer_id") + 1,
                "order_date": F.col("order_date") + F.expr("interval 1 day"),
                "total_amount": F.col("total_amount") + 10,
                "status": F.lit("Shipped"),
                "updated_at": at(NEW),
            }
        ),
        tables.ORDERS.merge,
        MergePlan.ONE_PASS,
    )


def merge_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = conform.order_items(spark, sf_dir)
    return merge_upsert(
        _history(items, "ship_date").drop("ship_date").withColumn("updated_at", at(OLD)),
        _feed(items, "ship_date")
        .drop("ship_date")
        .withColumns(
            {
                "order_id": F.col("order_id") + 1,
                "product_id": F.col("product_id") + 1,
                "quantity": F.col("quantity") + 1,
                "unit_price": F.col("unit_price") + 1,
                "updated_at": at(NEW),
            }
        ),
        tables.ORDER_ITEMS.merge,
        MergePlan.ONE_PASS,
    )


def merge_gold_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = conform.orders(spark, sf_dir)
    return merge_upsert(
        staged(gold.daily_sales(_history(orders, "order_date"), at(OLD))),
        staged(gold.daily_sales(_feed(orders, "order_date"), at(NEW))),
        tables.GOLD_DAILY_SALES.merge,
        MergePlan.ONE_PASS,
    )


def merge_gold_customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, known = conform.orders(spark, sf_dir), conform.customers(spark, sf_dir)
    return merge_upsert(
        staged(gold.customer_metrics(orders, known.filter("segment <> 'BUILDING'"), at(OLD))),
        staged(
            gold.customer_metrics(
                _feed(orders, "order_date"), known.filter("segment <> 'MACHINERY'"), at(NEW)
            )
        ),
        tables.GOLD_CUSTOMER_METRICS.merge,
        MergePlan.ONE_PASS,
    )


def merge_gold_category_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, catalog = conform.order_items(spark, sf_dir), conform.products(spark, sf_dir)
    return merge_upsert(
        staged(gold.category_performance(items, catalog.filter("category <> 'PROMO'"), at(OLD))),
        staged(
            gold.category_performance(
                _feed(items, "ship_date"), catalog.filter("category <> 'ECONOMY'"), at(NEW)
            )
        ),
        tables.GOLD_CATEGORY_PERFORMANCE.merge,
        MergePlan.ONE_PASS,
    )


def _sql(spec, target: str, source: str) -> str:
    key, updated = spec.merge.key, list(spec.merge.update)
    kept = [c for c in spec.schema.names if c != key and c not in updated]
    return shapes.merged(target, source, key, updated, kept)


def _plus(select: str, where: str, extra: str) -> str:
    return f"select *, {extra} from ({select}) where {where}"


_OLD_SQL, _NEW_SQL = f"timestamp '{OLD}'", f"timestamp '{NEW}'"
_BEFORE, _SINCE = "timestamp '2000-01-01'", "timestamp '1998-01-01'"
_STAMP_OLD, _STAMP_NEW = f"{_OLD_SQL} as updated_at", f"{_NEW_SQL} as updated_at"

QUERIES = {
    "merge_customers": merge_customers,
    "merge_products": merge_products,
    "merge_orders": merge_orders,
    "merge_order_items": merge_order_items,
    "merge_gold_daily_sales": merge_gold_daily_sales,
    "merge_gold_customer_metrics": merge_gold_customer_metrics,
    "merge_gold_category_performance": merge_gold_category_performance,
}

ORACLES = {
    "merge_customers": _sql(
        tables.CUSTOMERS,
        _plus(shapes.CUSTOMERS, "segment <> 'BUILDING'", f"{_OLD_SQL} as signup_date, {_STAMP_OLD}"),
        f"""select customer_id, name, 'new.' || email as email, 'NEW ' || country as country,
                   {_NEW_SQL} as signup_date, {_STAMP_NEW}
            from ({shapes.CUSTOMERS}) where segment <> 'MACHINERY'""",
    ),
    "merge_products": _sql(
        tables.PRODUCTS,
        _plus(shapes.PRODUCTS, "category <> 'PROMO'", _STAMP_OLD),
        f"""select product_id, name, lower(category) as category, price + 1 as price,
                   inventory_count + 5 as inventory_count, {_STAMP_NEW}
            from ({shapes.PRODUCTS}) where category <> 'ECONOMY'""",
    ),
    "merge_orders": _sql(
        tables.ORDERS,
        _plus(shapes.ORDERS, f"order_date < {_BEFORE}", _STAMP_OLD),
        f"""select order_id, customer_id + 1 as customer_id, order_date + interval 1 day as order_date,
                   total_amount + 10 as total_amount, 'Shipped' as status, {_STAMP_NEW}
            from ({shapes.ORDERS}) where order_date >= {_SINCE}""",
    ),
    "merge_order_items": _sql(
        tables.ORDER_ITEMS,
        _plus(shapes.ORDER_ITEMS, f"ship_date < {_BEFORE}", _STAMP_OLD),
        f"""select order_item_id, order_id + 1 as order_id, product_id + 1 as product_id,
                   quantity + 1 as quantity, unit_price + 1 as unit_price, {_STAMP_NEW}
            from ({shapes.ORDER_ITEMS}) where ship_date >= {_SINCE}""",
    ),
    "merge_gold_daily_sales": _sql(
        tables.GOLD_DAILY_SALES,
        f"select *, {_STAMP_OLD} from ({shapes.daily_sales(f'select * from ({shapes.ORDERS}) where order_date < {_BEFORE}')})",
        f"select *, {_STAMP_NEW} from ({shapes.daily_sales(f'select * from ({shapes.ORDERS}) where order_date >= {_SINCE}')})",
    ),
    "merge_gold_customer_metrics": _sql(
        tables.GOLD_CUSTOMER_METRICS,
        "select *, {} from ({})".format(
            _STAMP_OLD,
            shapes.customer_metrics(
                shapes.ORDERS, f"select * from ({shapes.CUSTOMERS}) where segment <> 'BUILDING'"
            ),
        ),
        "select *, {} from ({})".format(
            _STAMP_NEW,
            shapes.customer_metrics(
                f"select * from ({shapes.ORDERS}) where order_date >= {_SINCE}",
                f"select * from ({shapes.CUSTOMERS}) where segment <> 'MACHINERY'",
            ),
        ),
    ),
    "merge_gold_category_performance": _sql(
        tables.GOLD_CATEGORY_PERFORMANCE,
        "select *, {} from ({})".format(
            _STAMP_OLD,
            shapes.category_performance(
                shapes.ORDER_ITEMS, f"select * from ({shapes.PRODUCTS}) where category <> 'PROMO'"
            ),
        ),
        "select *, {} from ({})".format(
            _STAMP_NEW,
            shapes.category_performance(
                f"select * from ({shapes.ORDER_ITEMS}) where ship_date >= {_SINCE}",
                f"select * from ({shapes.PRODUCTS}) where category <> 'ECONOMY'",
            ),
        ),
    ),
}
