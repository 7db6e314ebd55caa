"""Frames written once so that several later steps can read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sediment.session import configured, scratch_dir

# Option of the parquet writer for whole tables, which go to disk several times.
PACKED = {"compression": "zstd"}

# Writes drop their shuffle files as soon as they are committed. Otherwise these stay on the
# executors' disks until the driver happens to collect its garbage, and a job of many staged
# steps would hold the shuffles of all of them at once.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def staged(df: DataFrame, reader: SparkSession | None = None, **options: str) -> DataFrame:
    """Write the frame as parquet to the shared scratch folder and read it back.

    Unlike a cache the copy survives the loss of executors, and its file sizes tell the
    planner how big it is, so a broadcast is decided on the real size. `reader` is the session
    of the returned frame, by default that of the given one; `options` go to the parquet writer.
    """
    path = scratch_dir(df.sparkSession)
    with configured(df.sparkSession, FREED):
        df.write.options(**options).parquet(path)
    return (reader or df.sparkSession).read.schema(df.schema).parquet(path)
