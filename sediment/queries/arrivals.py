"""What arrived and what did not, read from landed deliveries."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment import schemas
from sediment.operators import coverage
from sediment.queries import shapes
from sediment.queries.landed import landed_orders_by_day
from sediment.queries.runs import LAST_DELIVERY_SQL, RUN_DATES, land_orders
from sediment.session import scratch_dir
from sediment.sources import conform
from sediment.sources.landing import read_feed

FIRST, LAST = datetime.date(1995, 1, 1), datetime.date(2001, 12, 31)


def _last_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders that landed on the last run date, read from that day's folder."""
    landing = scratch_dir(spark)
    land_orders(spark, sf_dir, landing)
    return read_feed(spark, landing, schemas.ORDERS_FEED, RUN_DATES[-1])


def _expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.customers(spark, sf_dir).withColumn("customer_id", F.col("customer_id").cast("string"))


def landing_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per country: all customers are expected, those in the last delivery have landed."""
    return coverage.coverage(_expected(spark, sf_dir), _last_delivery(spark, sf_dir), "customer_id", by="country")


def landing_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.missing(_expected(spark, sf_dir), _last_delivery(spark, sf_dir), "customer_id")


def landing_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order status: runs of days without a landed order of that status."""
    landed = landed_orders_by_day(spark, sf_dir).withColumn("day", F.make_date("year", "month", "day"))
    expected = conform.orders(spark, sf_dir).select("status")
    return coverage.gaps(expected, landed, "status", "day", FIRST, LAST)


QUERIES = {
    "landing_coverage": landing_coverage,
    "landing_missing": landing_missing,
    "landing_gaps": landing_gaps,
}

LANDED_SQL = f"select distinct customer_id from ({LAST_DELIVERY_SQL})"

ORACLES = {
    "landing_coverage": f"""
  select country, count(*) as expected, count(l.customer_id) as landed, count(*) - count(l.customer_id) as missing
  from ({shapes.CUSTOMERS}) c left join ({LANDED_SQL}) l on c.customer_id = l.customer_id
  group by 1""",
    "landing_missing": f"""
  select cast(customer_id as varchar) as customer_id from ({shapes.CUSTOMERS})
  where customer_id not in ({LANDED_SQL})""",
    "landing_gaps": f"""
  with days as (
    select status, day from (select distinct status from ({shapes.ORDERS})) s,
           (select cast(unnest(generate_series(date '{FIRST}', date '{LAST}', interval 1 day)) as date) as day) d
  ),
  absent as (
    select status, day from days
    except select status, cast(order_date as date) from ({shapes.ORDERS})
  ),
  runs as (
    select status, day, day - cast(row_number() over (partition by status order by day) as integer) as island from absent
  )
  select status, min(day) as first_missing, max(day) as last_missing, cast(count(*) as integer) as days
  from runs group by status, island""",
}
