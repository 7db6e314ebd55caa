"""Silver and gold of new days with work that follows the days, not the history.

One run folds its days, looks each table up once, and notes what the upserts take away and add
(the images) under the namespace before any table changes. Silver is then merged, the images are
added to the stored parts of gold, and the gold tables are computed from the parts, which hold a
row per day, customer and product. Orders and items are not read again, but for groups whose
parts cannot be reckoned back (see `sediment.operators.parts`).

A run may be repeated after a failure at any point. Its noted images are used again, merging
silver twice changes nothing, and parts carry the run's name in the folder they are written to,
so that a run is added once. Run names must rise from run to run, as ISO dates do.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.functions.money import split, split_line
from sediment.operators import parts
from sediment.operators.gold import stamped
from sediment.plans import tables
from sediment.plans.jobs import open_feeds
from sediment.sinks.staging import PACKED, staged
from sediment.sinks.tables import (
    SIGN,
    PartitionMerge,
    TableSpec,
    create_namespace,
    create_table,
    in_values,
    mark_of,
    namespace_location,
    replace_table,
    upsert,
)

Aggregate = Callable[..., DataFrame]
BEFORE_ALL_RUNS = "0"
FACTS = (tables.ORDERS, tables.ORDER_ITEMS)
OF_ORDERS = ((tables.DAILY_PARTS, parts.daily_parts), (tables.CUSTOMER_PARTS, parts.customer_parts))
OF_ITEMS = ((tables.PRODUCT_PARTS, parts.product_parts),)
# The columns of an image that the parts are computed from.
NOTED = {
    tables.ORDERS.name: ("order_id", "customer_id", "order_date", "total_amount", "status"),
    tables.ORDER_ITEMS.name: ("product_id", "quantity", "unit_price"),
}


def _stored(path: str, spark: SparkSession) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _parts_table(spark: SparkSession, namespace: str, spec: TableSpec, aggregate: Aggregate, silver: str) -> str:
    """The table of parts; a new one starts with what the silver table holds."""
    table = create_table(spark, namespace, spec)
    if not mark_of(spark, table):
        replace_table(aggregate(spark.table(silver)).select(spec.schema.names), table, BEFORE_ALL_RUNS)
    return table


def noted_images(
    spark: SparkSession, folder: str, merges: dict[str, PartitionMerge]
) -> dict[str, DataFrame]:
    """The images of a run, in `NOTED` columns: those of an earlier try, if it wrote them all, else written now."""
    if _stored(f"{folder}/complete", spark) is None:
        for name, merge in merges.items():
            noted = merge.images().select(*NOTED[name], SIGN)
            noted.write.mode("overwrite").options(**PACKED).parquet(f"{folder}/{name}")
        spark.range(1).write.mode("overwrite").parquet(f"{folder}/complete")
    schemas = {
        name: merge.spark.table(merge.table).select(*NOTED[name]).schema.add(SIGN, "integer")
        for name, merge in merges.items()
    }
    return {name: spark.read.schema(schemas[name]).parquet(f"{folder}/{name}") for name in merges}


def _daily_anew(images: DataFrame, orders: DataFrame) -> DataFrame | None:
    day = F.to_date("order_date")
    stale = parts.rest_removed(images, day, "day", split(F.col("total_amount")), SIGN)
    days = [row[0] for row in stale.collect()]  # bounded by the calendar
    # An order lies in the folder of its day, and both are kept on a match.
    return parts.daily_parts(orders.filter(in_values("order_day", days))) if days else None


def _customers_anew(images: DataFrame, orders: DataFrame, stored: DataFrame) -> DataFrame | None:
    rest = parts.rest_removed(images, F.col("customer_id"), "customer_id", split(F.col("total_amount")), SIGN)
    stale = staged(rest.union(parts.date_removed(images, stored, SIGN)).distinct())
    if stale.isEmpty():
        return None
    return _of_groups(orders, stale, "customer_id", parts.customer_parts)


def _products_anew(images: DataFrame, items: DataFrame) -> DataFrame | None:
    line = split_line(F.col("quantity"), F.col("unit_price"))
    stale = staged(parts.rest_removed(images, F.col("product_id"), "product_id", line, SIGN))
    return None if stale.isEmpty() else _of_groups(items, stale, "product_id", parts.product_parts)


def _of_groups(rows: DataFrame, groups: DataFrame, key: str, aggregate: Aggregate) -> DataFrame:
    """The groups' parts from their own rows; a group without rows has an empty row of parts."""
    found = aggregate(rows.join(groups, key, "left_semi"))
    gone = groups.join(found.select(key), key, "left_anti").withColumn("held", F.lit(0).cast("long"))
    return found.unionByName(gone, allowMissingColumns=True)


def add_to_parts(
    spark: SparkSession, namespace: str, run: str, images: dict[str, DataFrame]
) -> None:
    """Add a run's images to the parts, each table once."""
    orders, items = (spark.table(f"{namespace}.{spec.name}") for spec in (tables.ORDERS, tables.ORDER_ITEMS))
    of_orders, of_items = images[tables.ORDERS.name], images[tables.ORDER_ITEMS.name]
    for spec, aggregate in (*OF_ORDERS, *OF_ITEMS):
        table = f"{namespace}.{spec.name}"
        if mark_of(spark, table) >= run:
            continue
        stored = spark.table(table)
        if spec is tables.DAILY_PARTS:
            own, anew = of_orders, _daily_anew(of_orders, orders)
        elif spec is tables.CUSTOMER_PARTS:
            own, anew = of_orders, _customers_anew(of_orders, orders, stored)
        else:
            own, anew = of_items, _products_anew(of_items, items)
        replace_table(parts.merged(stored, aggregate(own, SIGN), spec.merge.key, anew), table, run)


def gold_from_parts(spark: SparkSession, namespace: str, run_ts: datetime.datetime) -> None:
    """The three gold tables from the stored parts and the dimension tables."""
    daily, by_customer, by_product, customers, products = (
        spark.table(f"{namespace}.{spec.name}")
        for spec in (tables.DAILY_PARTS, tables.CUSTOMER_PARTS, tables.PRODUCT_PARTS, tables.CUSTOMERS, tables.PRODUCTS)
    )
    results = (
        (tables.GOLD_DAILY_SALES, parts.daily_sales(daily)),
        (tables.GOLD_CUSTOMER_METRICS, parts.customer_metrics(by_customer, customers)),
        (tables.GOLD_CATEGORY_PERFORMANCE, parts.category_performance(by_product, products)),
    )
    for spec, rows in results:
        upsert(spark, create_table(spark, namespace, spec), stamped(rows, run_ts), spec)


def run_by_deltas(
    spark: SparkSession,
    landing: str,
    namespace: str,
    dates: Sequence[datetime.date],
    run_ts: datetime.datetime,
    run: str | None = None,
) -> None:
    """Merge the landed days into silver and gold (plain parquet tables).

    The result is that of `bronze_to_silver` and `silver_to_gold`. `run` names the run, by
    default after its last day.
    """
    run = run or max(dates).isoformat()
    create_namespace(spark, namespace)
    sources = open_feeds(spark, landing, dates)
    full = {spec.name: create_table(spark, namespace, spec) for spec, _ in sources}
    for spec, aggregate in OF_ORDERS:
        _parts_table(spark, namespace, spec, aggregate, full[tables.ORDERS.name])
    for spec, aggregate in OF_ITEMS:
        _parts_table(spark, namespace, spec, aggregate, full[tables.ORDER_ITEMS.name])
    merges = {
        spec.name: PartitionMerge(spark, full[spec.name], rows, spec, whole_rows=True)
        for spec, rows in sources
        if spec in FACTS
    }
    images = noted_images(spark, f"{namespace_location(spark, namespace)}/__images/{run}", merges)
    for spec, rows in sources:
        if spec in FACTS:
            merges[spec.name].apply()
        else:
            upsert(spark, full[spec.name], rows, spec)
    add_to_parts(spark, namespace, run, images)
    gold_from_parts(spark, namespace, run_ts)
