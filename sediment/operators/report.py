"""Reporting query over all four silver tables, and table inspection."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.functions.money import sum_lines
from sediment.operators.gold import CANCELLED
from sediment.session import configured
from sediment.sinks.staging import staged


def country_category_revenue(
    order_items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """Units and revenue per customer country and product category, cancelled orders left out.

    Orders take the country at order level, before they meet the much larger items; the
    category comes last, so only lines of orders that count are looked up. The items are
    shuffled by order_id once, and by product_id only if the products are too big to broadcast.
    """
    sold = (
        orders.filter(F.col("status") != CANCELLED)
        .select("order_id", "customer_id")
        .join(customers.select("customer_id", "country"), "customer_id")
        .select("order_id", "country")
    )
    lines = order_items.select("order_id", "product_id", "quantity", "unit_price")
    return (
        lines.join(sold, "order_id")
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("country", "category")
        .agg(
            F.sum("quantity").alias("total_units_sold"),
            F.round(sum_lines(F.col("quantity"), F.col("unit_price")), 2).alias("total_revenue"),
        )
    )


def country_category_copartitioned(
    order_items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """The same report for orders and items that are both stored in buckets of order_id.

    They meet first, bucket by bucket, so no line is shuffled or sorted to find its order.
    """
    counted = orders.filter(F.col("status") != CANCELLED).select("order_id", "customer_id")
    lines = order_items.select("order_id", "product_id", "quantity", "unit_price").join(counted, "order_id")
    return (
        lines.join(customers.select("customer_id", "country"), "customer_id")
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("country", "category")
        .agg(
            F.sum("quantity").alias("total_units_sold"),
            F.round(sum_lines(F.col("quantity"), F.col("unit_price")), 2).alias("total_revenue"),
        )
    )


def ranked(report: DataFrame) -> DataFrame:
    """Highest revenue first; the group keys settle ties so that the order is total."""
    return report.orderBy(
        F.desc("total_revenue"), F.desc("total_units_sold"), F.asc("country"), F.asc("category")
    )


def top_n(report: DataFrame, n: int) -> DataFrame:
    return ranked(report).limit(n)


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and column list of every table, counted in one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counted)


# The file source that can answer a count from parquet footers, and the switch for it.
FROM_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def _counted_files(spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, str]) -> DataFrame:
    """Row and column count of each path; to be planned and run under FROM_FOOTERS."""

    def reader(name: str):
        return spark.read.schema(schemas[name]) if name in schemas else spark.read

    return profile({name: reader(name).parquet(path) for name, path in paths.items()})


def profile_files(
    spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, str] | None = None
) -> DataFrame:
    """Row count and number of columns of parquet files, by the numbers in their footers.

    No column is read, whatever the size of the files. A stated schema spares the look at a
    footer that finds it. Runs when it is called; the result has a row per path.
    """
    with configured(spark, FROM_FOOTERS):
        return staged(_counted_files(spark, paths, schemas or {}))


def profile_namespace(spark: SparkSession, namespace: str) -> DataFrame:
    """The profile of all tables of a namespace, without temporary views."""
    names = [row.tableName for row in list_tables(spark, namespace).collect()]  # one row per table
    return profile({name: spark.table(f"{namespace}.{name}") for name in names})


def list_namespaces(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW NAMESPACES IN {catalog}" if catalog else "SHOW NAMESPACES")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """Tables of a namespace, without the session's temporary views."""
    found = spark.sql(f"SHOW TABLES IN {namespace}")
    return found.filter(~F.col("isTemporary")).select("namespace", "tableName")


def show_tables(spark: SparkSession, namespace: str, rows: int = 5) -> None:
    """Print count, schema and a few rows of every table in a namespace."""
    names = [row.tableName for row in list_tables(spark, namespace).collect()]
    tables = {name: spark.table(f"{namespace}.{name}") for name in names}
    if not tables:
        return
    profile(tables).show(len(tables), truncate=False)
    for df in tables.values():
        df.printSchema()
        df.show(rows, truncate=False)
