"""Gold aggregates and reports over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sediment.operators import gold, report
from sediment.queries import shapes
from sediment.session import scratch_dir
from sediment.sinks.tables import create_namespace, write_bucketed
from sediment.sources import conform

TOP = 20
REPORT_BUCKETS = 16


def gold_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_sales(conform.orders(spark, sf_dir))


def gold_customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.customer_metrics(conform.orders(spark, sf_dir), conform.customers(spark, sf_dir))


def gold_category_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.category_performance(conform.order_items(spark, sf_dir), conform.products(spark, sf_dir))


def country_category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.country_category_revenue(
        conform.order_items(spark, sf_dir),
        conform.orders(spark, sf_dir),
        conform.customers(spark, sf_dir),
        conform.products(spark, sf_dir),
    )


def top_country_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top_n(country_category_revenue(spark, sf_dir), TOP)


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts from the file footers of all tables."""
    paths = {name: f"{sf_dir}/{name}.parquet" for name in conform.TABLE_SCHEMAS}
    return report.profile_files(spark, paths, conform.TABLE_SCHEMAS)


def country_category_copartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue report over copies of orders and items in buckets of order_id."""
    root = scratch_dir(spark)
    namespace = f"report_{root.rsplit('/', 1)[1]}"
    create_namespace(spark, namespace, root)
    copies = {"orders": conform.orders(spark, sf_dir), "order_items": conform.order_items(spark, sf_dir)}
    for name, rows in copies.items():
        write_bucketed(rows, f"{namespace}.{name}", "order_id", REPORT_BUCKETS, f"{root}/{name}")
    return report.country_category_copartitioned(
        spark.table(f"{namespace}.order_items"),
        spark.table(f"{namespace}.orders"),
        conform.customers(spark, sf_dir),
        conform.products(spark, sf_dir),
    )


REVENUE_SQL = f"""
  with sold as (
    select customers.country, orders.order_id
    from ({shapes.CUSTOMERS}) customers, ({shapes.ORDERS}) orders
    where orders.customer_id = customers.customer_id and orders.status is not null
      and not orders.status = 'Cancelled'
  ),
  lines as (
    select products.category, items.order_id, items.quantity as units,
           cast(items.unit_price as decimal(18, 2)) * items.quantity as amount
    from ({shapes.PRODUCTS}) products, ({shapes.ORDER_ITEMS}) items
    where items.product_id = products.product_id
  )
  select country, category, sum(units)::bigint as total_units_sold, round(sum(amount)::double, 2) as total_revenue
  from lines, sold where lines.order_id = sold.order_id
  group by country, category"""

QUERIES = {
    "gold_daily_sales": gold_daily_sales,
    "gold_customer_metrics": gold_customer_metrics,
    "gold_category_performance": gold_category_performance,
    "country_category_revenue": country_category_revenue,
    "top_country_category": top_country_category,
    "table_profile": table_profile,
    "country_category_copartitioned": country_category_copartitioned,
}

ORACLES = {
    "gold_daily_sales": shapes.daily_sales(shapes.ORDERS),
    "gold_customer_metrics": shapes.customer_metrics(shapes.ORDERS),
    "gold_category_performance": shapes.category_performance(shapes.ORDER_ITEMS),
    "country_category_revenue": REVENUE_SQL,
    "country_category_copartitioned": REVENUE_SQL,
    "top_country_category": f"""{REVENUE_SQL}
  order by total_revenue desc, total_units_sold desc, country, category limit {TOP}""",
    "table_profile": " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count, {len(ddl.split(', '))} as column_count from {name}"
        for name, ddl in conform.TABLE_SCHEMAS.items()
    ),
}
