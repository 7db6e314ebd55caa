"""Price snapshots made of the events table: one coin per event type, price = value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.operators import prices
from sediment.plans.jobs import PRICE_DAY, load_prices, store_prices
from sediment.queries.landed import without_zone
from sediment.session import scratch_dir
from sediment.sinks.tables import create_namespace, create_or_append
from sediment.sources import conform
from sediment.sources.landing import read_snapshots
from sediment.streaming.incremental import append_new_snapshots

# The coins that prices_flatten_known states; its feed holds no others.
ENTITIES = ("click", "error", "purchase", "signup", "view")


def _epoch(ts: str) -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide row per instant with a struct column per event type seen at that instant."""
    metrics = F.struct(
        F.col("value").alias("usd"),
        (F.col("value") * 1000).alias("usd_market_cap"),
        F.col("user_id").alias("usd_24h_vol"),
        (F.col("value") - 10).alias("usd_24h_change"),
        _epoch("ts").alias("last_updated_at"),
    )
    events = conform.table(spark, sf_dir, "events")
    return events.groupBy("ts").pivot("event_type").agg(F.max(metrics))


def _land(spark: SparkSession, sf_dir: str, root: str, condition: Column) -> None:
    day = {"year": "yyyy", "month": "MM", "day": "dd"}
    wide = snapshots(spark, sf_dir).filter(condition)
    folders = wide.withColumns({name: F.date_format("ts", text) for name, text in day.items()})
    folders.drop("ts").hint("rebalance", *day).write.mode("append").partitionBy(*day).json(root)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark)
    _land(spark, sf_dir, root, F.lit(True))
    return root


def prices_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema inferred from the landed files; a snapshot without a coin gives a row of NULLs."""
    return without_zone(prices.flatten(read_snapshots(spark, _landed(spark, sf_dir))))


def prices_flatten_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stated coins, no inference pass, rows without any value left out."""
    wide = read_snapshots(spark, _landed(spark, sf_dir), prices.snapshot_schema(ENTITIES))
    return without_zone(prices.flatten(wide, drop_empty=True))


def prices_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price table after its job has run twice over the landed feed."""
    landed, root = _landed(spark, sf_dir), scratch_dir(spark)
    namespace = f"prices_{root.rsplit('/', 1)[1]}"
    create_namespace(spark, namespace, root)
    for _ in range(2):
        load_prices(spark, landed, f"{namespace}.crypto_prices")
    return without_zone(spark.table(f"{namespace}.crypto_prices"))


def prices_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price table, in folders by day, after two runs of the stream.

    The first run finds the days before 2024-01-16. Then all days land, the early ones again, and
    the second run meets late rows that it must not store a second time.
    """
    root, home = scratch_dir(spark), scratch_dir(spark)
    namespace = f"prices_{home.rsplit('/', 1)[1]}"
    create_namespace(spark, namespace, home)
    table, progress = f"{namespace}.crypto_prices", scratch_dir(spark)
    for early_only in (True, False):
        _land(spark, sf_dir, root, F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz") if early_only else F.lit(True))
        append_new_snapshots(spark, root, table, ENTITIES, progress, by_day=True).awaitTermination()
    return without_zone(spark.table(table).drop(PRICE_DAY))


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = conform.table(spark, sf_dir, "events")
    return events.select(
        F.col("event_type").alias("coin_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"),
        F.col("value").alias("price_usd"),
        "event_id",
        "ts",
    )


def prices_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event per coin and hour."""
    return prices.dedup(_hourly(spark, sf_dir).drop("ts"), order_by=["event_id"])


def _stored(spark: SparkSession, first: DataFrame, second: DataFrame) -> DataFrame:
    """Create a table from the first batch, append the second, read the table."""
    root = scratch_dir(spark)
    namespace = f"prices_{root.rsplit('/', 1)[1]}"
    create_namespace(spark, namespace, root)
    for batch in (first, second):
        create_or_append(batch, f"{namespace}.crypto_prices")
    return spark.table(f"{namespace}.crypto_prices")


def _before(day: str) -> Column:
    return F.col("ts") < F.lit(day).cast("timestamp_ntz")


def create_or_append_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain append: rows that occur in both batches are stored twice."""
    feed = _hourly(spark, sf_dir)
    stored = _stored(spark, feed.filter(_before("2024-01-20")), feed.filter(~_before("2024-01-10")))
    return stored.drop("ts")


def append_new_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append without duplicates: hours of the second batch that are stored already are left out."""
    feed = _hourly(spark, sf_dir)
    first = prices.dedup(feed.filter(_before("2024-01-20")).drop("ts"), order_by=["event_id"])
    again = prices.dedup(feed.filter(~_before("2024-01-10")).drop("ts"), order_by=[F.desc("event_id")])
    root = scratch_dir(spark)
    table = f"prices_{root.rsplit('/', 1)[1]}.crypto_prices"
    create_namespace(spark, table.split(".")[0], root)
    for batch in (first, again):
        store_prices(batch, table)
    return spark.table(table)


QUERIES = {
    "prices_flatten": prices_flatten,
    "prices_flatten_known": prices_flatten_known,
    "prices_job": prices_job,
    "prices_stream": prices_stream,
    "prices_dedup": prices_dedup,
    "create_or_append_prices": create_or_append_prices,
    "append_new_prices": append_new_prices,
}


# Every instant with every event type: the largest event of the type then, or NULLs.
_FLAT_SQL = """
  select c.coin_id, m.usd as price_usd, m.cap as market_cap_usd, m.vol as volume_24h_usd,
         m.chg as change_24h_percent, to_timestamp(m.epoch)::timestamptz at time zone 'UTC' as timestamp
  from (select distinct ts from events) t
  cross join (select distinct event_type as coin_id from events) c
  left join (
    select ts, event_type, max({'usd': value, 'cap': value * 1000, 'vol': cast(user_id as double), 'chg': value - 10,
                                'epoch': cast(floor(epoch(ts)) as bigint)}) as m
    from events group by ts, event_type) e on e.ts = t.ts and e.event_type = c.coin_id"""
_HOURLY_SQL = """
  select event_type as coin_id, date_trunc('hour', ts) as timestamp, value as price_usd, event_id, ts
  from events"""


def _first_sql(where: str, order: str) -> str:
    return f"""
  select coin_id, timestamp, price_usd, event_id
  from (select *, row_number() over (partition by coin_id, timestamp order by {order}) as rn
        from ({_HOURLY_SQL}) where {where})
  where rn = 1"""


_EARLY, _LATE = "ts < timestamp '2024-01-20'", "ts >= timestamp '2024-01-10'"

_JOB_SQL = f"""
  select * from ({_FLAT_SQL})
  qualify row_number() over (
    partition by coin_id, timestamp
    order by price_usd nulls last, market_cap_usd nulls last, volume_24h_usd nulls last, change_24h_percent nulls last) = 1"""

ORACLES = {
    "prices_flatten": _FLAT_SQL,
    "prices_flatten_known": f"select * from ({_FLAT_SQL}) where timestamp is not null",
    "prices_job": _JOB_SQL,
    "prices_stream": _JOB_SQL,
    "prices_dedup": _first_sql("true", "event_id"),
    "create_or_append_prices": f"""
  select * exclude (ts) from ({_HOURLY_SQL}) where {_EARLY}
  union all
  select * exclude (ts) from ({_HOURLY_SQL}) where {_LATE}""",
    "append_new_prices": f"""
  with stored as ({_first_sql(_EARLY, 'event_id')})
  select * from stored
  union all
  select * from ({_first_sql(_LATE, 'event_id desc')}) b
  where not exists (select 1 from stored s where s.coin_id = b.coin_id and s.timestamp = b.timestamp)""",
}
