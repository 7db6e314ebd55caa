"""Wide price snapshots (one struct column per coin) to a long, deduplicated price table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sediment.functions.parsing import epoch_to_timestamp
from sediment.operators.keys import first_per_key, quoted, unseen

# Field of a coin's struct in the landing file -> column of the price table.
PRICE_FIELDS = {
    "usd": "price_usd",
    "usd_market_cap": "market_cap_usd",
    "usd_24h_vol": "volume_24h_usd",
    "usd_24h_change": "change_24h_percent",
}
EPOCH_FIELD = "last_updated_at"
PRICE_KEY = ("coin_id", "timestamp")


def snapshot_schema(entities: Iterable[str]) -> StructType:
    """Schema of a snapshot with the given coins; reading with it spares the inference pass."""
    metrics = StructType()
    for field in PRICE_FIELDS:
        metrics = metrics.add(field, "double")
    metrics = metrics.add(EPOCH_FIELD, "long")
    schema = StructType()
    for entity in entities:
        schema = schema.add(entity, metrics)
    return schema


def entity_columns(snapshots: DataFrame) -> list[str]:
    """Struct columns with a price field are coins; other structs, such as an ingest record, are not."""
    names = [
        f.name
        for f in snapshots.schema.fields
        if isinstance(f.dataType, StructType) and set(PRICE_FIELDS) & set(f.dataType.names)
    ]
    if not names:
        raise ValueError("no struct column found: the frame holds no coin")
    return names


def _metrics(snapshots: DataFrame, entity: str) -> Column:
    """The coin's struct under the table's names and types; a field it lacks is NULL."""
    present = set(snapshots.schema[entity].dataType.names)

    def field(name: str, data_type: str) -> Column:
        if name not in present:
            return F.lit(None).cast(data_type)
        return F.col(quoted(entity)).getField(name).try_cast(data_type)

    columns = [field(name, "double").alias(column) for name, column in PRICE_FIELDS.items()]
    return F.struct(*columns, field(EPOCH_FIELD, "bigint").alias(EPOCH_FIELD))


def flatten(
    snapshots: DataFrame, entities: Sequence[str] | None = None, drop_empty: bool = False
) -> DataFrame:
    """One row per snapshot and coin.

    A snapshot without one of the coins gives a row of NULLs for it, unless `drop_empty`.
    """
    pairs: list[Column] = []
    for entity in entities or entity_columns(snapshots):
        pairs += [F.lit(entity), _metrics(snapshots, entity)]
    long = snapshots.select(F.explode(F.create_map(*pairs)).alias("coin_id", "metrics"))
    flat = long.select(
        "coin_id",
        *[F.col("metrics").getField(column).alias(column) for column in PRICE_FIELDS.values()],
        epoch_to_timestamp(F.col("metrics").getField(EPOCH_FIELD)).alias("timestamp"),
    )
    if drop_empty:
        flat = flat.dropna("all", subset=[c for c in flat.columns if c != "coin_id"])
    return flat


def _coins(value: Column) -> Column:
    """Coin -> its fields as text, for JSON text of a snapshot; values without a price field are left out."""
    fields = F.array(*[F.lit(name) for name in PRICE_FIELDS])
    parsed = F.transform_values(
        F.from_json(value, "map<string, string>"), lambda _, text: F.from_json(text, "map<string, string>")
    )
    return F.map_filter(parsed, lambda _, held: F.coalesce(F.arrays_overlap(F.map_keys(held), fields), F.lit(False)))


def coins_of(texts: DataFrame, column: str = "value") -> list[str]:
    """The coins that any snapshot text holds; one short name per coin reaches the driver."""
    names = texts.select(F.explode(F.map_keys(_coins(F.col(column)))).alias("coin_id")).distinct()
    return sorted(row[0] for row in names.collect())


def flatten_text(texts: DataFrame, always: Sequence[str] = (), column: str = "value") -> DataFrame:
    """One row per snapshot text and coin it holds, whatever the coins are.

    A snapshot without one of the coins in `always` gives a row of NULLs for it. The plan does
    not grow with the number of coins, and no schema is inferred.
    """
    held = texts.select(_coins(F.col(column)).alias("coins")).filter("coins is not null")
    stated = F.array(*[F.lit(name) for name in always]).cast("array<string>")
    long = held.select("coins", F.explode(F.array_union(stated, F.map_keys("coins"))).alias("coin_id"))
    metrics = F.try_element_at("coins", F.col("coin_id"))

    def field(name: str, data_type: str) -> Column:
        return F.try_element_at(metrics, F.lit(name)).try_cast(data_type)

    return long.select(
        "coin_id",
        *[field(name, "double").alias(renamed) for name, renamed in PRICE_FIELDS.items()],
        epoch_to_timestamp(field(EPOCH_FIELD, "bigint")).alias("timestamp"),
    )


def dedup(
    prices: DataFrame, keys: Sequence[str] = PRICE_KEY, order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per coin and timestamp. Without an order the smallest values win, and any value
    wins over NULL."""
    order = order_by or [F.col(quoted(c)).asc_nulls_last() for c in prices.columns if c not in keys]
    return first_per_key(prices, keys, order)


def not_yet_stored(batch: DataFrame, stored: DataFrame, keys: Sequence[str] = PRICE_KEY) -> DataFrame:
    """Rows of the batch whose key the table lacks; a NULL timestamp equals a NULL timestamp."""
    return unseen(batch, stored, keys, null_safe=True, small_source=True)
