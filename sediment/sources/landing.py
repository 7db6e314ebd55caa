"""Readers of the landing area: JSON snapshots, JSON by day, payload text."""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sediment.functions.parsing import parse_timestamps
from sediment.schemas import Feed

# Folder names of one day below a feed's root.
DAY_FOLDERS = "year={0:%Y}/month={0:%m}/day={0:%d}"
DAY_COLUMNS = ("year", "month", "day")
LANDED = "__landed"  # the day a row landed under, where rows of several days come together


def parse_run_date(text: str) -> datetime.date:
    """`YYYY-MM-DD` -> date; anything else is an error."""
    return datetime.datetime.strptime(text, "%Y-%m-%d").date()


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with a stated schema; a value of the wrong type is NULL, a junk line all NULL."""
    return spark.read.schema(schema).json(path)


def read_days(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Every day below `root`; filters on year, month and day prune folders."""
    days = StructType([*schema.fields])
    for name in DAY_COLUMNS:
        days = days.add(name, "integer")
    return spark.read.schema(days).json(root)


def read_day(
    spark: SparkSession, root: str, schema: StructType, run_date: datetime.date
) -> DataFrame:
    """One day of a feed, without its partition columns; a day without files is empty.

    Only the day's folder is listed, however many days the feed holds, and the planner sees
    the size of that day rather than of the whole history.
    """
    try:
        return read_snapshot(spark, f"{root}/{DAY_FOLDERS.format(run_date)}", schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    # The day is missing. A missing feed is still an error, raised by this listing.
    return read_days(spark, root, schema).filter(F.lit(False)).drop(*DAY_COLUMNS)


def with_landed_day(df: DataFrame) -> DataFrame:
    """The three folder columns as one date, `LANDED`."""
    return df.withColumn(LANDED, F.make_date(*DAY_COLUMNS)).drop(*DAY_COLUMNS)


def read_feed_days(spark: SparkSession, landing: str, feed: Feed, dates: Iterable[datetime.date]) -> DataFrame:
    """Typed rows of several days of a feed with the day they landed under (`LANDED`).

    Only the folders of these days are listed; days without files hold no rows, and a missing
    feed is an error.
    """
    root = f"{landing}/{feed.path}"
    columns = StructType([*feed.schema.fields])
    for name in DAY_COLUMNS:
        columns = columns.add(name, "integer")
    folders = ",".join(DAY_FOLDERS.format(day) for day in sorted(set(dates)))
    try:
        raw = spark.read.schema(columns).option("basePath", root).json(f"{root}/{{{folders}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = read_days(spark, root, feed.schema).filter(F.lit(False))
    return with_landed_day(parse_timestamps(raw, *feed.timestamps))


def read_feed(spark: SparkSession, landing: str, feed: Feed, run_date: datetime.date) -> DataFrame:
    """A feed as typed rows: snapshot or one day, text timestamps parsed."""
    path = f"{landing}/{feed.path}"
    raw = (
        read_day(spark, path, feed.schema, run_date)
        if feed.daily
        else read_snapshot(spark, path, feed.schema)
    )
    return parse_timestamps(raw, *feed.timestamps)


def read_snapshots(
    spark: SparkSession, root: str, schema: StructType | None = None, one_object_per_file: bool = False
) -> DataFrame:
    """Wide snapshots below `root`, all days.

    Without a schema Spark infers one in an extra pass over every file. `one_object_per_file`
    is for indented JSON; on JSON lines it would silently return one object per file.
    """
    reader = spark.read.option("multiLine", one_object_per_file)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(root)


def read_snapshot_texts(spark: SparkSession, root: str, one_object_per_file: bool = False) -> DataFrame:
    """The snapshots below `root` as JSON text in the column `value`, all days."""
    return spark.read.text(root, wholetext=one_object_per_file).select("value")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: its path and its whole text."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload"))


def is_json_object(payload: Column) -> Column:
    """True for text holding one JSON object; false for other JSON, junk, empty text and NULL.

    A JSON reader stops at the end of the first value. Read as the only element of an array,
    the text must hold nothing else, unless it closes the array itself; then it does not close
    an object around it, so it is read as the only field of one as well.
    """
    parsed = F.from_json(
        F.concat(F.lit("["), payload, F.lit("]")),
        "array<map<string, string>>",
        {"allowSingleQuotes": "false"},
    )
    single = (F.size(parsed) == 1) & F.get(parsed, F.lit(0)).isNotNull()
    field = F.from_json(
        F.concat(F.lit('{"x":'), payload, F.lit("}")),
        "x map<string, string>",
        {"allowSingleQuotes": "false"},
    )
    closed = F.rtrim(payload, F.lit(" \t\r\n")).endswith("}")
    return F.coalesce(closed & single & field["x"].isNotNull(), F.lit(False))


def split_payloads(payloads: DataFrame, column: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Payload rows that are JSON objects, and the rejected rest.

    Each half reads the payloads; where one result can hold both, `is_json_object` marks the
    rows in one pass.
    """
    accepted = is_json_object(F.col(column))
    return payloads.filter(accepted), payloads.filter(~accepted)


def parse_payloads(accepted: DataFrame, schema: StructType | str, column: str = "payload") -> DataFrame:
    """Replace the payload text of accepted rows by the schema's columns."""
    others = [c for c in accepted.columns if c != column]
    parsed = accepted.withColumn(column, F.from_json(F.col(column), schema))
    return parsed.select(*others, f"{column}.*")
