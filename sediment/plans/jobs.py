"""The jobs a scheduler runs, one call each."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment import schemas
from sediment.functions.parsing import parse_timestamps
from sediment.operators import gold, prices
from sediment.operators.fold import fold_days
from sediment.plans import tables
from sediment.sinks.staging import PACKED, staged
from sediment.sinks.tables import TableSpec, create_namespace, create_or_append, create_table, in_values, upsert
from sediment.sources.landing import LANDED, read_feed_days, read_snapshot, read_snapshot_texts

PRICE_DAY = "price_day"

# In the order of tables.SILVER.
FEEDS = (schemas.CUSTOMERS_FEED, schemas.PRODUCTS_FEED, schemas.ORDERS_FEED, schemas.ORDER_ITEMS_FEED)


def folder_filled(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Fill the folder column that plain parquet tables have in addition; needs `LANDED`."""
    if spec is tables.ORDERS:
        return df.withColumn("order_day", F.to_date("order_date"))
    if spec is tables.ORDER_ITEMS:
        return df.withColumn("landed_day", F.col(LANDED))
    return df


def open_feeds(
    spark: SparkSession, landing: str, dates: Sequence[datetime.date], provider: str = "parquet"
) -> list[tuple[TableSpec, DataFrame]]:
    """The four feeds as sources of an upsert each: two snapshots, and the days of orders and items.

    Several days are folded into one source, with the effect of merging them in date order.
    """
    opened = []
    for feed, spec in zip(FEEDS, tables.SILVER, strict=True):
        if feed.daily:
            rows = read_feed_days(spark, landing, feed, dates)
            rows = folder_filled(rows, spec) if provider == "parquet" else rows
        else:
            rows = parse_timestamps(read_snapshot(spark, f"{landing}/{feed.path}", feed.schema), *feed.timestamps)
        opened.append((spec, feed.daily, rows))
    if len(set(dates)) == 1:  # a day is merged as it was delivered
        return [(spec, rows.drop(LANDED)) for spec, _, rows in opened]
    return [(spec, fold_days(staged(rows, **PACKED), LANDED, spec.merge) if daily else rows) for spec, daily, rows in opened]


def bronze_to_silver(
    spark: SparkSession,
    landing: str,
    namespace: str,
    run_date: datetime.date | Sequence[datetime.date],
    provider: str = "parquet",
) -> set[datetime.date | None] | None:
    """Merge the customer and product snapshots and one or more days of orders and items into silver.

    Several days take one upsert per table. All four feeds are opened before the first table
    changes, so a missing feed stops the run early. A day without files merges nothing. Returns
    the order days whose orders may have changed, or None where the table format does not tell.
    """
    create_namespace(spark, namespace)
    dates = [run_date] if isinstance(run_date, datetime.date) else list(run_date)
    order_days = None
    for spec, rows in open_feeds(spark, landing, dates, provider):
        changed = upsert(spark, create_table(spark, namespace, spec, provider), rows, spec)
        if spec is tables.ORDERS:
            order_days = changed
    return order_days


def silver_to_gold(
    spark: SparkSession,
    namespace: str,
    run_ts: datetime.datetime,
    provider: str = "parquet",
    order_days: set[datetime.date | None] | None = None,
) -> None:
    """Recompute the three gold tables from silver and merge them.

    With `order_days` (as `bronze_to_silver` returns them) the daily sales read only the
    folders of those days. Their values are the same; days left out keep their `updated_at`.
    """
    orders, order_items, customers, products = (
        spark.table(f"{namespace}.{spec.name}")
        for spec in (tables.ORDERS, tables.ORDER_ITEMS, tables.CUSTOMERS, tables.PRODUCTS)
    )
    changed = orders if order_days is None else orders.filter(in_values("order_day", order_days))
    results = (
        (tables.GOLD_DAILY_SALES, gold.daily_sales(changed, run_ts)),
        (tables.GOLD_CUSTOMER_METRICS, gold.customer_metrics(orders, customers, run_ts)),
        (tables.GOLD_CATEGORY_PERFORMANCE, gold.category_performance(order_items, products, run_ts)),
    )
    for spec, rows in results:
        upsert(spark, create_table(spark, namespace, spec, provider), rows, spec)


def load_prices(
    spark: SparkSession,
    root: str,
    table: str,
    entities: Sequence[str] | None = None,
    one_object_per_file: bool = False,
    skip_stored: bool = True,
    provider: str = "parquet",
) -> None:
    """Flatten, deduplicate and append the price snapshots below `root`, with all coins they hold.

    A snapshot without one of `entities` gives a row of NULLs for it; by default these are the
    coins that any snapshot holds, which takes a pass of its own, and with an empty list there
    are no such rows.
    Every run reads all snapshots; `sediment.streaming.incremental.append_new_snapshots` reads
    new files only. `skip_stored` leaves out rows the table already holds; without it a
    repeated run appends them again.
    """
    texts = read_snapshot_texts(spark, root, one_object_per_file)
    always = prices.coins_of(texts) if entities is None else entities
    store_prices(prices.flatten_text(texts, always), table, skip_stored, provider)


def store_prices(
    flat: DataFrame, table: str, skip_stored: bool = True, provider: str = "parquet", by_day: bool = False
) -> None:
    """Deduplicate flat price rows and append them to the price table.

    `by_day` keeps the table in folders by the day of `timestamp` (column `price_day`). Rows
    that are stored already are then looked for in the folders of the batch's days only, so a
    batch of new prices meets a day of the table, and a late row the day it belongs to.
    """
    spark = flat.sparkSession
    batch = prices.dedup(flat)
    create_namespace(spark, table.rsplit(".", 1)[0])
    if by_day:
        batch = batch.withColumn(PRICE_DAY, F.to_date("timestamp"))
    if skip_stored and spark.catalog.tableExists(table):
        batch = staged(batch)
        stored = stored_days(spark, table, batch) if by_day else spark.table(table)
        batch = prices.not_yet_stored(batch, stored)
    create_or_append(batch, table, provider, PRICE_DAY if by_day else None)


def stored_days(spark: SparkSession, table: str, batch: DataFrame) -> DataFrame:
    """The price table's folders for the days of a batch, which are few: bounded by the calendar."""
    days = [row[0] for row in batch.select(PRICE_DAY).distinct().collect()]
    return spark.table(table).filter(in_values(PRICE_DAY, days))


def backfill(
    spark: SparkSession,
    landing: str,
    namespace: str,
    dates: Iterable[datetime.date],
    run_ts: Callable[[datetime.date], datetime.datetime],
    provider: str = "parquet",
    changed_days_only: bool = False,
) -> None:
    """Catch up on several days at once, with the result of daily runs in date order.

    Silver takes one upsert per table and gold is computed once; `run_ts` gives the timestamp of
    the last day, which is stamped on the gold rows.
    """
    days = sorted(set(dates))
    if not days:
        return
    order_days = bronze_to_silver(spark, landing, namespace, days, provider)
    silver_to_gold(spark, namespace, run_ts(days[-1]), provider, order_days if changed_days_only else None)
