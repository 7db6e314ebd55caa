"""Text and number parsing that yields NULL on bad input, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the text form of every timestamp in the landing files.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT))


def parse_timestamps(df: DataFrame, *names: str) -> DataFrame:
    """Replace the named text columns by timestamps; unparsable text becomes NULL."""
    return df.withColumns({name: parse_timestamp(F.col(name)) for name in names})


def print_timestamps(df: DataFrame, *names: str) -> DataFrame:
    """Replace the named timestamp columns by their landing text form."""
    return df.withColumns({name: F.date_format(F.col(name), TIMESTAMP_FORMAT) for name in names})


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds -> timestamp, without a round trip through local-time text."""
    return F.timestamp_seconds(seconds.try_cast("bigint"))
