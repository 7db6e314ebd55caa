"""Whole pipeline runs: three days of deliveries that together hold the whole tables.

Orders and their items are delivered by age on three run dates. The orders of December
1997 are delivered a second time on the last date, with a new amount and status.
"""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment import schemas
from sediment.operators import report
from sediment.plans import tables
from sediment.plans.deltas import run_by_deltas
from sediment.plans.jobs import backfill, bronze_to_silver
from sediment.queries import shapes
from sediment.queries.landed import (
    landing_customers,
    landing_order_items,
    landing_orders,
    landing_products,
    without_zone,
)
from sediment.session import scratch_dir
from sediment.sinks.landing import land_days, land_snapshot
from sediment.sinks.tables import create_namespace, create_table, upsert
from sediment.streaming.incremental import merge_new_days

RUN_DATES = tuple(datetime.date(2026, 6, day) for day in (10, 11, 12))


def _delivery(day: str) -> Column:
    """Run date on which an order of that day is first delivered."""
    first, second, third = (F.lit(d) for d in RUN_DATES)
    date = F.to_date(day)
    return F.when(date < "1997-05-01", first).when(date < "1999-07-01", second).otherwise(third)


def land_orders(spark: SparkSession, sf_dir: str, landing: str) -> None:
    orders = landing_orders(spark, sf_dir).withColumn("delivered", _delivery("order_date"))
    again = orders.filter(F.date_format("order_date", "yyyy-MM") == "1997-12").withColumns(
        {
            "total_amount": F.col("total_amount") + 1,
            "status": F.lit("Returned"),
            "customer_id": F.col("customer_id") + 1,  # must be kept by the merge
            "delivered": F.lit(RUN_DATES[-1]),
        }
    )
    feed = schemas.ORDERS_FEED
    deliveries = orders.unionAll(again)
    land_days(
        deliveries.select(*feed.schema.names, "delivered").transform(_deliver_on),
        f"{landing}/{feed.path}",
        F.to_date(F.concat_ws("-", "year", "month", "day")),
        feed.timestamps,
        gather=False,  # as few days as RUN_DATES has
    )


def _deliver_on(df: DataFrame) -> DataFrame:
    """Replace the delivery date by the three folder columns."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    return df.withColumns({n: F.date_format("delivered", f) for n, f in parts.items()}).drop("delivered")


def _land(spark: SparkSession, sf_dir: str) -> str:
    landing = scratch_dir(spark)
    for feed, rows in (
        (schemas.CUSTOMERS_FEED, landing_customers(spark, sf_dir)),
        (schemas.PRODUCTS_FEED, landing_products(spark, sf_dir)),
    ):
        land_snapshot(rows.select(feed.schema.names), f"{landing}/{feed.path}", feed.timestamps)
    land_orders(spark, sf_dir, landing)
    feed = schemas.ORDER_ITEMS_FEED
    items = landing_order_items(spark, sf_dir).withColumn("delivered", _delivery("updated_at"))
    land_days(
        items.select(*feed.schema.names, "delivered").transform(_deliver_on),
        f"{landing}/{feed.path}",
        F.to_date(F.concat_ws("-", "year", "month", "day")),
        feed.timestamps,
        gather=False,
    )
    return landing


def _fresh_namespace(spark: SparkSession) -> str:
    root = scratch_dir(spark)
    namespace = f"run_{root.rsplit('/', 1)[1]}"
    create_namespace(spark, namespace, root)
    return namespace


def backfill_three_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three gold tables after the backfill, as (table, group, amount, count) rows."""
    namespace = _fresh_namespace(spark)
    backfill(
        spark,
        _land(spark, sf_dir),
        namespace,
        RUN_DATES,
        run_ts=lambda day: datetime.datetime.combine(day, datetime.time(6)),
    )

    def rows(spec, group: str, amount: str, count: str) -> DataFrame:
        return spark.table(f"{namespace}.{spec.name}").select(
            F.lit(spec.name).alias("table_name"),
            F.col(group).cast("string").alias("group_key"),
            F.col(amount).alias("amount"),
            F.col(count).alias("quantity"),
        )

    return (
        rows(tables.GOLD_DAILY_SALES, "order_date", "total_revenue", "cancelled_orders_count")
        .unionAll(rows(tables.GOLD_CUSTOMER_METRICS, "customer_id", "total_spent", "total_orders"))
        .unionAll(rows(tables.GOLD_CATEGORY_PERFORMANCE, "category", "revenue_generated", "units_sold"))
    )


def _all_columns(spark: SparkSession, namespace: str, specs) -> DataFrame:
    """Every row and column of the tables, one under the other; columns a table lacks are NULL; dates as text."""

    def rows(spec) -> DataFrame:
        held = without_zone(spark.table(f"{namespace}.{spec.name}").select(spec.schema.names))
        dates = {f.name: F.col(f.name).cast("string") for f in held.schema.fields if f.dataType.typeName() == "date"}
        return held.withColumns({"table_name": F.lit(spec.name), **dates})

    frames = [rows(spec) for spec in specs]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), frames)


def _run_at(day: datetime.date) -> datetime.datetime:
    return datetime.datetime.combine(day, datetime.time(6))


def silver_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four silver tables, all columns, after one run over the three deliveries."""
    namespace = _fresh_namespace(spark)
    bronze_to_silver(spark, _land(spark, sf_dir), namespace, RUN_DATES)
    return _all_columns(spark, namespace, tables.SILVER)


def gold_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three gold tables, all columns, computed in full after the backfill."""
    namespace = _fresh_namespace(spark)
    backfill(spark, _land(spark, sf_dir), namespace, RUN_DATES, run_ts=_run_at)
    return _all_columns(spark, namespace, tables.GOLD)


def namespace_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table that the run leaves in its namespace; a temporary view is not among them."""
    namespace = _fresh_namespace(spark)
    bronze_to_silver(spark, _land(spark, sf_dir), namespace, RUN_DATES)
    spark.table(f"{namespace}.orders").createOrReplaceTempView("orders_of_the_run")
    return report.profile_namespace(spark, namespace).drop("column_count")


def gold_by_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tables after three runs that add each delivery's changes to the stored parts."""
    namespace, landing = _fresh_namespace(spark), _land(spark, sf_dir)
    for day in RUN_DATES:
        run_by_deltas(spark, landing, namespace, [day], _run_at(day))
    return _all_columns(spark, namespace, tables.GOLD)


def incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver orders after one stream run over the three deliveries."""
    namespace, landing = _fresh_namespace(spark), scratch_dir(spark)
    land_orders(spark, sf_dir, landing)
    merge_new_days(
        spark, landing, schemas.ORDERS_FEED, namespace, tables.ORDERS, scratch_dir(spark)
    ).awaitTermination()
    return without_zone(spark.table(f"{namespace}.{tables.ORDERS.name}").drop("order_day"))


def orders_by_day_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders stored by day; a date range on the folder column reads only its folders."""
    namespace = _fresh_namespace(spark)
    table = create_table(spark, namespace, tables.ORDERS)
    rows = landing_orders(spark, sf_dir).withColumn("order_day", F.to_date("order_date"))
    upsert(spark, table, rows, tables.ORDERS)
    in_range = F.col("order_day").between("1998-01-01", "1998-12-31")
    return without_zone(spark.table(table).filter(in_range))


QUERIES = {
    "backfill_three_days": backfill_three_days,
    "silver_tables": silver_tables,
    "gold_tables": gold_tables,
    "gold_by_deltas": gold_by_deltas,
    "namespace_profile": namespace_profile,
    "incremental_orders": incremental_orders,
    "orders_by_day_partition": orders_by_day_partition,
}

_AGAIN = "strftime(order_date, '%Y-%m') = '1997-12'"
FINAL_ORDERS_SQL = f"""
  select order_id, customer_id, order_date,
         case when {_AGAIN} then total_amount + 1 else total_amount end as total_amount,
         case when {_AGAIN} then 'Returned' else status end as status
  from ({shapes.ORDERS})"""


# The orders as the last run date delivers them: new ones, and those delivered again with another customer.
LAST_DELIVERY_SQL = f"""
  select order_id, customer_id from ({shapes.ORDERS}) where cast(order_date as date) >= date '1999-07-01'
  union all
  select order_id, customer_id + 1 from ({shapes.ORDERS}) where {_AGAIN}"""
_RUN_AT_SQL = f"timestamp '{_run_at(RUN_DATES[-1])}' as updated_at"
_GOLD_SQL = f"""
  select 'gold_daily_sales' as table_name, * replace (cast(order_date as varchar) as order_date), {_RUN_AT_SQL}
  from ({shapes.daily_sales(FINAL_ORDERS_SQL)})
  union all by name
  select 'gold_customer_metrics' as table_name, * replace (cast(customer_id as varchar) as customer_id), {_RUN_AT_SQL}
  from ({shapes.customer_metrics(FINAL_ORDERS_SQL)})
  union all by name
  select 'gold_category_performance' as table_name, *, {_RUN_AT_SQL}
  from ({shapes.category_performance(shapes.ORDER_ITEMS)})"""

ORACLES = {
    "silver_tables": f"""
  select 'customers' as table_name, cast(customer_id as varchar) as customer_id, name, email, country,
         timestamp '2020-01-01 00:07:00' + to_hours(cast(customer_id as int)) as signup_date,
         timestamp '2026-06-10' as updated_at
  from ({shapes.CUSTOMERS})
  union all by name
  select 'products' as table_name, cast(product_id as varchar) as product_id, name, category, price, inventory_count,
         timestamp '2026-06-10' as updated_at
  from ({shapes.PRODUCTS})
  union all by name
  select 'orders' as table_name, cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id,
         order_date, total_amount, status, order_date as updated_at
  from ({FINAL_ORDERS_SQL})
  union all by name
  select 'order_items' as table_name, order_item_id, cast(i.order_id as varchar) as order_id,
         cast(product_id as varchar) as product_id, quantity, unit_price, o.order_date as updated_at
  from ({shapes.ORDER_ITEMS}) i join ({shapes.ORDERS}) o on i.order_id = o.order_id""",
    "gold_tables": _GOLD_SQL,
    "gold_by_deltas": _GOLD_SQL,
    "namespace_profile": """
  select 'customers' as table_name, count(*) as row_count from customer
  union all select 'products', count(*) from part
  union all select 'orders', count(*) from orders
  union all select 'order_items', count(*) from lineitem""",
    "backfill_three_days": f"""
  select 'gold_daily_sales' as table_name, cast(order_date as varchar) as group_key,
         total_revenue as amount, cancelled_orders_count as quantity
  from ({shapes.daily_sales(FINAL_ORDERS_SQL)})
  union all
  select 'gold_customer_metrics', cast(customer_id as varchar), total_spent, total_orders
  from ({shapes.customer_metrics(FINAL_ORDERS_SQL)})
  union all
  select 'gold_category_performance', category, revenue_generated, units_sold
  from ({shapes.category_performance(shapes.ORDER_ITEMS)})""",
    "incremental_orders": f"""
  select cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id, order_date,
         total_amount, status, order_date as updated_at
  from ({FINAL_ORDERS_SQL})""",
    "orders_by_day_partition": f"""
  select cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id, order_date,
         total_amount, status, order_date as updated_at, cast(order_date as date) as order_day
  from ({shapes.ORDERS}) where cast(order_date as date) between date '1998-01-01' and date '1998-12-31'""",
}
