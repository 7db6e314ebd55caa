"""Landing round trips: whole tables are written as JSON to a fresh folder and read back."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sediment import schemas
from sediment.functions.parsing import parse_timestamps
from sediment.queries import shapes
from sediment.session import scratch_dir
from sediment.sinks.staging import staged
from sediment.sinks.landing import append_payloads, land_days, land_snapshot, quarantine, with_ingest_metadata
from sediment.sources import conform
from sediment.sources.landing import (
    DAY_COLUMNS,
    is_json_object,
    read_days,
    read_feed,
)
from sediment.sources.manifest import manifest, manifest_changes
from sediment.sources.rescue import read_rescued

RUN_DATE = datetime.date(1998, 3, 22)
INGESTED_AT = "2026-06-10 06:30:00"


def without_zone(df: DataFrame) -> DataFrame:
    """Zoned timestamps as wall-clock timestamps, the form the checks compare."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def landing_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    signup = F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, cast(customer_id as int), 7)")
    return (
        conform.customers(spark, sf_dir)
        .drop("segment")
        .withColumns({"signup_date": signup, "updated_at": F.lit("2026-06-10 00:00:00").cast("timestamp_ntz")})
    )


def landing_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.products(spark, sf_dir).withColumn(
        "updated_at", F.lit("2026-06-10 00:00:00").cast("timestamp_ntz")
    )


def landing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.orders(spark, sf_dir).withColumn("updated_at", F.col("order_date"))


def landing_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items land under the day of their order, which they carry as updated_at.

    The lines meet their orders by their plain keys; the longer item id is made from them afterwards.
    """
    dates = conform.orders(spark, sf_dir).select(
        F.col("order_id").alias("l_orderkey"), F.col("order_date").alias("updated_at")
    )
    lines = conform.table(spark, sf_dir, "lineitem").join(dates, "l_orderkey")
    return lines.select(*conform.item_columns(), "updated_at").drop("ship_date")


def _land_snapshot(rows: DataFrame, feed: schemas.Feed) -> str:
    landing = scratch_dir(rows.sparkSession)
    land_snapshot(rows.select(feed.schema.names), f"{landing}/{feed.path}", feed.timestamps)
    return landing


def _land_days(rows: DataFrame, feed: schemas.Feed, day: str) -> str:
    landing = scratch_dir(rows.sparkSession)
    land_days(rows.select(feed.schema.names), f"{landing}/{feed.path}", F.col(day), feed.timestamps)
    return landing


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = schemas.CUSTOMERS_FEED
    landing = _land_snapshot(landing_customers(spark, sf_dir), feed)
    return without_zone(read_feed(spark, landing, feed, RUN_DATE))


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = schemas.PRODUCTS_FEED
    landing = _land_snapshot(landing_products(spark, sf_dir), feed)
    return without_zone(read_feed(spark, landing, feed, RUN_DATE))


def landed_orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = schemas.ORDERS_FEED
    landing = _land_days(landing_orders(spark, sf_dir), feed, "order_date")
    return parse_timestamps(read_days(spark, f"{landing}/{feed.path}", feed.schema), *feed.timestamps)


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days, with the folder each order lies in."""
    return without_zone(landed_orders_by_day(spark, sf_dir))


def bronze_orders_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run date's orders, out of the whole landed table."""
    feed = schemas.ORDERS_FEED
    landing = _land_days(landing_orders(spark, sf_dir), feed, "order_date")
    return without_zone(read_feed(spark, landing, feed, RUN_DATE))


def bronze_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = schemas.ORDER_ITEMS_FEED
    landing = _land_days(landing_order_items(spark, sf_dir), feed, "updated_at")
    rows = read_days(spark, f"{landing}/{feed.path}", feed.schema)
    return without_zone(parse_timestamps(rows, *feed.timestamps))


def bronze_items_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = schemas.ORDER_ITEMS_FEED
    landing = _land_days(landing_order_items(spark, sf_dir), feed, "updated_at")
    return without_zone(read_feed(spark, landing, feed, RUN_DATE))


def land_with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a payload with its ingest record, appended by day and read back."""
    events = conform.table(spark, sf_dir, "events")
    payloads = with_ingest_metadata(
        events.select("event_id", "event_type", "value", "props", "ts"),
        city=F.col("event_type"),
        ingested_at=F.lit(INGESTED_AT).cast("timestamp_ntz"),
        execution_date=F.to_date("ts"),
    )
    root = f"{scratch_dir(spark)}/weather"
    append_payloads(payloads.drop("event_type", "ts"), root, F.lit(INGESTED_AT).cast("timestamp_ntz"))
    landed = spark.read.schema(
        "event_id BIGINT, value DOUBLE, props STRING, snapshot_ts STRING, "
        "metadata STRUCT<city: STRING, ingested_at: STRING, execution_date: STRING>, "
        "year INT, month INT, day INT"
    ).json(root)
    return landed.select("event_id", "value", "props", "snapshot_ts", "metadata.*", *DAY_COLUMNS)


def payload_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON objects, prose and markup, as one feed of payload texts."""
    events = conform.table(spark, sf_dir, "events")
    documents = conform.table(spark, sf_dir, "documents")
    pages = conform.table(spark, sf_dir, "pages")
    return (
        events.select(F.lit("events").alias("feed"), F.col("event_id").alias("id"), F.col("props").alias("payload"))
        .unionAll(documents.select(F.lit("documents"), "doc_id", "text"))
        .unionAll(pages.select(F.lit("pages"), "page_id", "html"))
    )


def reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every payload with its length and verdict, marked in one pass."""
    payload = F.col("payload")
    return payload_texts(spark, sf_dir).select(
        "feed",
        "id",
        F.length(payload).cast("bigint").alias("characters"),
        F.when(is_json_object(payload), "accepted").otherwise("rejected").alias("verdict"),
    )


def quarantined_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payloads as they lie in quarantine, with the rows of their verdict that the write counted."""
    root = scratch_dir(spark)
    counts = quarantine(payload_texts(spark, sf_dir), root)
    counted = F.when(F.col("verdict") == "accepted", counts["accepted"]).otherwise(counts["rejected"])
    return spark.read.parquet(root).select(
        "feed", "id", F.length("payload").cast("bigint").alias("characters"), "verdict", counted.cast("bigint").alias("counted")
    )


RESCUE_SCHEMA = StructType().add("event_id", "long").add("event_type", "string").add("value", "double").add("at", "timestamp")


def rescued_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as text lines with faults: wrong types, unknown fields, lines cut off, blank lines."""
    number = F.col("event_id") % 10
    whole = F.to_json(
        F.struct(
            "event_id",
            F.when(number == 1, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"),
            F.when(number == 2, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"),
            F.when(number == 3, F.col("user_id")).alias("user id"),
        )
    )
    # Numbers stand unquoted, as a feed would write them.
    plain = F.regexp_replace(whole, r'"value":"([0-9.eE+-]+)"', r'"value":$1')
    line = F.when(number == 4, F.substring(plain, 1, 20)).when(number == 5, F.concat(plain, F.lit(" {}"))).otherwise(plain)
    root = scratch_dir(spark)
    conform.table(spark, sf_dir, "events").select(
        F.concat(line, F.when(number == 6, "\n \t").otherwise("")).alias("value")
    ).write.text(root)
    rows = read_rescued(spark, root, RESCUE_SCHEMA)
    entries = F.transform(F.map_entries("rescued"), lambda held: F.concat(held["key"], F.lit("="), held["value"]))
    return without_zone(rows.withColumn("rescued", F.array_join(F.array_sort(entries), ";")))


def _landed_day():
    """The day of a manifest's folder."""
    digits = F.regexp_extract_all("folder", F.lit(r"=(\d+)"), F.lit(1))
    return F.to_date(F.array_join(digits, "-"))


def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, bytes and digest of the landed lines of each day, all order columns."""
    feed = schemas.ORDERS_FEED
    landing = _land_days(landing_orders(spark, sf_dir), feed, "order_date")
    return manifest(spark, f"{landing}/{feed.path}").select(_landed_day().alias("landed_day"), "rows", "bytes", "digest")


def landing_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose orders differ between two deliveries of the whole history.

    The second one has new statuses in May 1998, lacks 1996 before July, and has days after 2000
    that the first one lacks; all its other rows land again in other files and another order.
    """
    feed = schemas.ORDERS_FEED
    orders = landing_orders(spark, sf_dir)
    first = orders.filter(F.year("order_date") <= 2000)
    month = F.date_format("order_date", "yyyy-MM")
    second = (
        orders.filter(~month.between("1996-01", "1996-06"))
        .withColumn("status", F.when(month == "1998-05", "Returned").otherwise(F.col("status")))
        .orderBy(F.desc("order_id"))
    )
    before, after = (
        staged(manifest(spark, f"{_land_days(rows, feed, 'order_date')}/{feed.path}")) for rows in (first, second)
    )
    return manifest_changes(before, after).select(_landed_day().alias("landed_day"), "change", "rows_before", "rows_after")


QUERIES = {
    "bronze_customers": bronze_customers,
    "bronze_products": bronze_products,
    "bronze_orders": bronze_orders,
    "bronze_orders_day": bronze_orders_day,
    "bronze_items": bronze_items,
    "bronze_items_day": bronze_items_day,
    "land_with_metadata": land_with_metadata,
    "reject_split": reject_split,
    "landing_manifest": landing_manifest,
    "manifest_changes": landing_changes,
    "quarantined_payloads": quarantined_payloads,
    "rescued_events": rescued_events,
}

_ORDERS_SQL = f"""
  select cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id, order_date,
         total_amount, status, order_date as updated_at
  from ({shapes.ORDERS})"""
_ITEMS_SQL = f"""
  select order_item_id, cast(i.order_id as varchar) as order_id, cast(product_id as varchar) as product_id,
         quantity, unit_price, o.order_date as updated_at
  from ({shapes.ORDER_ITEMS}) i join ({shapes.ORDERS}) o on i.order_id = o.order_id"""
_FOLDERS = """cast(extract(year from {0}) as int) as year, cast(extract(month from {0}) as int) as month,
         cast(extract(day from {0}) as int) as day"""
# The JSON line of an order, as the landing writes it.
_LINES_SQL = f"""
  select order_date, '{{"order_id":' || order_id || ',"customer_id":' || customer_id || ',"order_date":"'
         || strftime(order_date, '%Y-%m-%d %H:%M:%S') || '","total_amount":' || total_amount || ',"status":"' || status
         || '","updated_at":"' || strftime(updated_at, '%Y-%m-%d %H:%M:%S') || '"}}' as line
  from ({_ORDERS_SQL})"""
_DIGEST_SQL = " || '-' || ".join(
    f"sum(('0x' || substr(md5(line), {8 * i + 1}, 8))::hugeint)::varchar" for i in range(4)
)
_ON_RUN_DATE = f"= date '{RUN_DATE}'"

ORACLES = {
    "bronze_customers": f"""
  select cast(customer_id as varchar) as customer_id, name, email, country,
         timestamp '2020-01-01 00:07:00' + to_hours(cast(customer_id as int)) as signup_date,
         timestamp '2026-06-10' as updated_at
  from ({shapes.CUSTOMERS})""",
    "bronze_products": f"""
  select cast(product_id as varchar) as product_id, name, category, price, inventory_count,
         timestamp '2026-06-10' as updated_at
  from ({shapes.PRODUCTS})""",
    "bronze_orders": f"select *, {_FOLDERS.format('order_date')} from ({_ORDERS_SQL})",
    "bronze_orders_day": f"select * from ({_ORDERS_SQL}) where cast(order_date as date) {_ON_RUN_DATE}",
    "bronze_items": f"select *, {_FOLDERS.format('updated_at')} from ({_ITEMS_SQL})",
    "bronze_items_day": f"select * from ({_ITEMS_SQL}) where cast(updated_at as date) {_ON_RUN_DATE}",
    "land_with_metadata": f"""
  select event_id, value, props, '20260610T063000Z' as snapshot_ts, event_type as city,
         '{INGESTED_AT}' as ingested_at, strftime(ts, '%Y-%m-%d') as execution_date,
         2026 as year, 6 as month, 10 as day
  from events""",
    "reject_split": """
  select feed, id, length(payload) as characters,
         case when payload is not null and json_valid(payload) and json_type(payload) = 'OBJECT'
              then 'accepted' else 'rejected' end as verdict
  from (select 'events' as feed, event_id as id, props as payload from events
        union all select 'documents', doc_id, text from documents
        union all select 'pages', page_id, html from pages)""",
    "quarantined_payloads": """
  select feed, id, length(payload) as characters, verdict, count(*) over (partition by verdict) as counted
  from (select feed, id, payload,
               case when payload is not null and json_valid(payload) and json_type(payload) = 'OBJECT'
                    then 'accepted' else 'rejected' end as verdict
        from (select 'events' as feed, event_id as id, props as payload from events
              union all select 'documents', doc_id, text from documents
              union all select 'pages', page_id, html from pages))""",
    "rescued_events": """
  with lines as (
    select event_id, event_id % 10 as k, event_type, value, ts, user_id,
           '{"event_id":' || event_id || case when event_id % 10 = 1 then '' else ',"event_type":"' || event_type || '"' end
           || ',"value":' || value || ',"at":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"}' as plain
    from events
  )
  select case when k not in (4, 5) then event_id end as event_id,
         case when k not in (1, 4, 5) then event_type end as event_type,
         case when k not in (2, 4, 5) then value end as value,
         case when k not in (4, 5) then date_trunc('second', ts) end as at,
         case k when 2 then 'value=n/a' when 3 then 'user id=' || user_id when 4 then '_line=' || substr(plain, 1, 20)
                when 5 then '_line=' || plain || ' {}' end as rescued
  from lines""",
    "landing_manifest": f"""
  select cast(order_date as date) as landed_day, count(*) as rows, cast(sum(octet_length(encode(line)) + 1) as bigint) as bytes,
         {_DIGEST_SQL} as digest
  from ({_LINES_SQL}) group by 1""",
    "manifest_changes": f"""
  with lines as ({_LINES_SQL}),
  before as (
    select cast(order_date as date) as day, count(*) as n from lines where year(order_date) <= 2000 group by 1
  ),
  after as (
    select cast(order_date as date) as day, count(*) as n,
           bool_or(strftime(order_date, '%Y-%m') = '1998-05') as edited
    from lines where strftime(order_date, '%Y-%m') not between '1996-01' and '1996-06' group by 1
  )
  select coalesce(b.day, a.day) as landed_day,
         case when b.n is null then 'added' when a.n is null then 'removed' else 'changed' end as change,
         b.n as rows_before, a.n as rows_after
  from before b full join after a on a.day = b.day
  where b.n is null or a.n is null or a.edited""",
}
