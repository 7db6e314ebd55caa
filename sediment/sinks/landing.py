"""Writers of the landing area."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sediment.functions.parsing import print_timestamps
from sediment.operators.keys import quoted
from sediment.sources.landing import DAY_COLUMNS, is_json_object

VERDICT = "verdict"

# Fixed value: text form of a snapshot's UTC time.
SNAPSHOT_TIME_FORMAT = "yyyyMMdd'T'HHmmss'Z'"

# JSON lines repeat every field name. Readers tell the codec by the file's ending; a file is one task's output,
# and the rebalance keeps that small enough to be read as a whole. The fastest level takes no longer than plain text.
PACKED_LINES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
_DAY = "__day"


def _with_day_folders(df: DataFrame, day: Column, gather: bool = True) -> DataFrame:
    """Zero-padded text, so that folders read year=2026/month=06/day=09.

    The rebalance hint gathers a day's rows into few files and lets adaptive execution
    split a day that is too large for one task. Rows move with the day alone; the texts are
    made where they are written.
    """
    folders = dict(zip(DAY_COLUMNS, ("yyyy", "MM", "dd")))
    dated = df.withColumn(_DAY, F.to_date(day))
    if gather:
        dated = dated.hint("rebalance", _DAY)
    return dated.withColumns({name: F.date_format(_DAY, fmt) for name, fmt in folders.items()}).drop(_DAY)


def land_snapshot(df: DataFrame, path: str, timestamps: tuple[str, ...] = ()) -> None:
    """Replace the dimension snapshot at `path` by JSON lines of the whole frame.

    They stay plain text: a snapshot may be one file, which only plain text lets many tasks read.
    """
    print_timestamps(df, *timestamps).write.mode("overwrite").json(path)


def land_days(
    df: DataFrame, root: str, day: Column, timestamps: tuple[str, ...] = (), gather: bool = True
) -> None:
    """Write JSON lines by day. Days in the frame are replaced, all others stay.

    A frame of few days needs no `gather`: a task then writes a file for each of its days, and
    no row is shuffled.
    """
    partitioned = _with_day_folders(df, day, gather)
    (
        print_timestamps(partitioned, *timestamps)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DAY_COLUMNS)
        .options(**PACKED_LINES)
        .json(root)
    )


def append_payloads(df: DataFrame, root: str, taken_at: Column) -> None:
    """Add payload rows under the day they were taken at, marked with that UTC time."""
    marked = df.withColumn("snapshot_ts", F.date_format(taken_at, SNAPSHOT_TIME_FORMAT))
    writer = _with_day_folders(marked, taken_at).write.mode("append").partitionBy(*DAY_COLUMNS)
    writer.options(**PACKED_LINES).json(root)


def quarantine(payloads: DataFrame, root: str, column: str = "payload") -> dict[str, int]:
    """Append the payload rows below `root`, JSON objects in verdict=accepted, the rest in verdict=rejected.

    One pass: every payload is parsed once, and the rows of each verdict are counted while they
    are written. Returns these counts.
    """
    accepted = is_json_object(F.col(quoted(column)))
    counts = Observation()
    marked = payloads.withColumn(VERDICT, F.when(accepted, "accepted").otherwise("rejected"))
    seen = marked.observe(
        counts, *[F.count_if(F.col(VERDICT) == name).alias(name) for name in ("accepted", "rejected")]
    )
    seen.write.mode("append").partitionBy(VERDICT).parquet(root)
    return counts.get


def with_ingest_metadata(
    payloads: DataFrame, city: Column, ingested_at: Column, execution_date: datetime.date | Column
) -> DataFrame:
    """Attach the ingest record {city, ingested_at, execution_date}, all as text."""
    return payloads.withColumn(
        "metadata",
        F.struct(
            city.alias("city"),
            F.date_format(ingested_at, "yyyy-MM-dd HH:mm:ss").alias("ingested_at"),
            F.date_format(F.lit(execution_date), "yyyy-MM-dd").alias("execution_date"),
        ),
    )
