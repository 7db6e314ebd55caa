"""Which expected entities arrived, and which did not."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sediment.operators.keys import quoted


def missing(expected: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Expected entities without a landed row."""
    arrived = landed.select(F.col(quoted(key))).distinct()
    return expected.select(F.col(quoted(key))).distinct().join(arrived, key, "left_anti")


def coverage(expected: DataFrame, landed: DataFrame, key: str, by: str | None = None) -> DataFrame:
    """Counts of expected, landed and missing entities, overall or per value of `by`."""
    arrived = landed.select(F.col(quoted(key))).distinct().withColumn("arrived", F.lit(True))
    groups = [by] if by else []
    wanted = expected.select(key, *groups).distinct()
    return (
        wanted.join(arrived, key, "left")
        .groupBy(*groups)
        .agg(
            F.count(F.lit(1)).alias("expected"),
            F.count("arrived").alias("landed"),
            F.count_if(F.col("arrived").isNull()).alias("missing"),
        )
    )


def gaps(
    expected: DataFrame, landed: DataFrame, key: str, day: str, first: datetime.date, last: datetime.date
) -> DataFrame:
    """Runs of days in [first, last] on which an expected entity has no landed row: key,
    first_missing, last_missing, days.

    Landed days are reduced to one row per entity and day before they are put in order, so a
    window holds at most the days of the calendar. The day before the first and the day after
    the last stand at the ends of each entity, which also covers entities without any row.
    """
    on = F.col(quoted(day))
    arrived = landed.select(F.col(quoted(key)).alias(key), on.alias("day")).filter(F.col("day").between(first, last))
    ends = F.array(F.date_sub(F.lit(first), 1), F.date_add(F.lit(last), 1))
    wanted = expected.select(F.col(quoted(key))).distinct()
    held = arrived.distinct().join(wanted, key, "left_semi").select(key, "day")
    order = Window.partitionBy(quoted(key)).orderBy("day")
    return (
        held.unionAll(wanted.select(key, F.explode(ends).alias("day")))
        .withColumn("following", F.lead("day").over(order))
        .filter(F.datediff("following", "day") > 1)
        .select(
            key,
            F.date_add("day", 1).alias("first_missing"),
            F.date_sub("following", 1).alias("last_missing"),
            (F.datediff("following", "day") - 1).alias("days"),
        )
    )
