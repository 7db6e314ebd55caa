"""Take in whatever has landed since the last run, tracked by a stream checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sediment.functions.parsing import parse_timestamps
from sediment.operators.fold import fold_days
from sediment.operators.prices import flatten_text
from sediment.plans.jobs import folder_filled, store_prices
from sediment.schemas import Feed
from sediment.sinks.staging import staged
from sediment.sinks.tables import TableSpec, create_namespace, create_table, upsert
from sediment.sources.landing import DAY_COLUMNS, LANDED, with_landed_day


def read_feed_stream(spark: SparkSession, landing: str, feed: Feed) -> DataFrame:
    """New files of a daily feed as they land, with the day they landed under."""
    columns = StructType([*feed.schema.fields])
    for name in DAY_COLUMNS:
        columns = columns.add(name, "integer")
    raw = spark.readStream.schema(columns).json(f"{landing}/{feed.path}")
    return parse_timestamps(raw, *feed.timestamps)


def merge_new_days(
    spark: SparkSession,
    landing: str,
    feed: Feed,
    namespace: str,
    spec: TableSpec,
    checkpoint: str,
    provider: str = "parquet",
) -> StreamingQuery:
    """Start a run over all files not seen before; it stops when they are merged.

    The days of a batch are folded into one source, with the effect of merging them in date
    order, as in a backfill: an order delivered again on a later day updates the earlier one.
    The table is looked up once per batch. A batch repeated after a failure merges the same
    rows again; rows without a key may then be inserted twice.
    """
    create_namespace(spark, namespace)
    table = create_table(spark, namespace, spec, provider)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        # The batch belongs to a clone of the session. Tables are read and written through
        # the caller's session, whose file listings a write then refreshes.
        dated = with_landed_day(staged(batch, spark))
        rows = folder_filled(dated, spec) if provider == "parquet" else dated
        upsert(spark, table, fold_days(rows, LANDED, spec.merge), spec)

    return (
        read_feed_stream(spark, landing, feed)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_new_snapshots(
    spark: SparkSession,
    root: str,
    table: str,
    entities: Sequence[str],
    checkpoint: str,
    one_object_per_file: bool = False,
    provider: str = "parquet",
    by_day: bool = False,
) -> StreamingQuery:
    """Start a run that appends the prices of snapshot files not seen before, whatever their coins.

    A snapshot without one of `entities` gives a row of NULLs for it.
    Prices the table already holds are left out, so a repeated batch appends nothing. With
    `by_day` they are looked for in the folders of the batch's days, however old (`store_prices`).
    """
    snapshots = spark.readStream.option("wholetext", one_object_per_file).text(root)

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        store_prices(
            flatten_text(staged(batch.select("value"), spark), entities), table, provider=provider, by_day=by_day
        )

    return (
        snapshots.writeStream.foreachBatch(append_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
