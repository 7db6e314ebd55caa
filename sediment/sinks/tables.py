"""Catalog tables: create, append, upsert.

With a table format that has MERGE (such as Iceberg, configured through the session options)
the upsert is one SQL statement. Plain parquet tables have no MERGE. There the new files are
written beside the old ones and the catalog is pointed at them when they are complete, so a
failed write never harms the table; one writer per table is assumed. Files of earlier
versions stay until an operator removes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sediment.operators.keys import key_filter, quoted
from sediment.operators.upsert import (
    MergePlan,
    MergeSpec,
    aligned,
    merge_upsert,
    split_source,
    update_matched,
)
from sediment.sinks.staging import PACKED, staged

# A batch of that many rows in that few folders is appended without a shuffle: its tasks write few
# files each, and large ones.
FEW_FOLDERS = 4
MANY_ROWS = 1_000_000

MOST_MET = 1_000_000  # hashes of stored keys that a large batch meets, looked up before whole rows are shuffled
_HASH = "__hash"


@dataclass(frozen=True)
class Partitioning:
    """How rows of a plain parquet table are spread over folders.

    The column is filled when a row is inserted and kept on a match, so rows never move
    between folders and an upsert rewrites only the folders that hold a matched row.
    """

    column: str
    data_type: str = "DATE"
    buckets: int | None = None

    @classmethod
    def by_key(cls, column: str, buckets: int) -> Partitioning:
        """Folders by the hash of the merge key, for tables that arrive as whole snapshots.

        Each row carries a fingerprint of the columns that a match overwrites. An upsert first
        compares keys and fingerprints, and only rows that are new or differ go on, so that the
        folders without any of them stay as they are.
        """
        return cls(column, "INT", buckets)


@dataclass(frozen=True)
class TableSpec:
    """Name, columns, merge rule and layout of a table."""

    name: str
    schema: StructType
    merge: MergeSpec
    partitioning: Partitioning | None = None
    transform: str | None = None  # partition transform for table formats that have them


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{at}")


def _described(spark: SparkSession, statement: str) -> dict[str, str]:
    return {row[0]: row[1] for row in spark.sql(statement).collect()}


def namespace_location(spark: SparkSession, namespace: str) -> str:
    return _described(spark, f"DESCRIBE NAMESPACE EXTENDED {namespace}")["Location"].rstrip("/")


def create_table(spark: SparkSession, namespace: str, spec: TableSpec, provider: str = "parquet") -> str:
    """Create the table if it is absent and return its full name."""
    table = f"{namespace}.{spec.name}"
    if spark.catalog.tableExists(table):
        return table
    columns = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in spec.schema.fields]
    layout = ""
    if provider == "parquet":
        root = namespace_location(spark, namespace)
        if spec.partitioning and spec.partitioning.buckets:
            columns.append(f"{FINGERPRINT} BINARY")
        if spec.partitioning:
            columns.append(f"{quoted(spec.partitioning.column)} {spec.partitioning.data_type}")
            layout = f" PARTITIONED BY ({quoted(spec.partitioning.column)})"
        layout += f" OPTIONS (compression '{PACKED['compression']}') LOCATION '{root}/{spec.name}/{uuid.uuid4().hex}'"
    elif spec.transform:
        layout = f" PARTITIONED BY ({spec.transform})"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) USING {provider}{layout}")
    return table


def create_or_append(df: DataFrame, table: str, provider: str = "parquet", folder: str | None = None) -> None:
    """Create the table from the frame's own schema, or append to it by column name.

    `folder` names a column that the table is partitioned by.
    """
    if df.sparkSession.catalog.tableExists(table):
        writer = df.write.format(provider).mode("append")
        (writer.partitionBy(folder) if folder else writer).saveAsTable(table)
    else:
        new = df.writeTo(table).using(provider).tableProperty("write.format.default", "parquet")
        (new.partitionedBy(F.col(quoted(folder))) if folder else new).create()


def _next_location(spark: SparkSession, table: str) -> str:
    """A new folder beside the table's current one."""
    current = _described(spark, f"DESCRIBE TABLE EXTENDED {table}")["Location"]
    return f"{current.rsplit('/', 1)[0]}/{uuid.uuid4().hex}"


def replace_table(df: DataFrame, table: str, mark: str = "") -> None:
    """Write the frame as the table's new content; it may be computed from the old content.

    `mark` becomes part of the new folder's name, so that content and mark change in one step.
    """
    spark = df.sparkSession
    location = _next_location(spark, table) + (f"-{mark}" if mark else "")
    df.write.options(**PACKED).parquet(location)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def mark_of(spark: SparkSession, table: str) -> str:
    """The mark that the table's content was written with, or an empty text."""
    folder = _described(spark, f"DESCRIBE TABLE EXTENDED {table}")["Location"].rstrip("/").rsplit("/", 1)[1]
    return folder.partition("-")[2]


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, location: str) -> None:
    """A copy of the frame in buckets of the key, one sorted file per bucket.

    Two tables with the same key and number of buckets are joined on it without a shuffle.
    """
    (
        df.repartition(buckets, F.col(quoted(key)))
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", location)
        .format("parquet")
        .saveAsTable(table)
    )


def replace_partitions(df: DataFrame, table: str, column: str, values: Collection) -> None:
    """Write new content for the listed partitions; all other partitions are untouched."""
    spark = df.sparkSession
    location = _next_location(spark, table)
    df.hint("rebalance", column).write.options(**PACKED).partitionBy(column).parquet(location)
    for value in values:
        folder = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
        literal = "null" if value is None else str(value) if isinstance(value, int) else f"DATE '{value}'"
        spark.sql(
            f"ALTER TABLE {table} PARTITION ({quoted(column)} = {literal}) "
            f"SET LOCATION '{location}/{column}={folder}'"
        )
    spark.catalog.refreshTable(table)


def merge_statement(table: str, source: str, merge: MergeSpec) -> str:
    assignments = ", ".join(f"t.{quoted(c)} = s.{quoted(c)}" for c in merge.update)
    return (
        f"MERGE INTO {table} t USING {source} s ON t.{quoted(merge.key)} = s.{quoted(merge.key)} "
        f"WHEN MATCHED THEN UPDATE SET {assignments} WHEN NOT MATCHED THEN INSERT *"
    )


def in_values(column: str, values: Collection) -> Column:
    """The column holds one of the values; None stands for NULL."""
    held = F.col(quoted(column)).isin([value for value in values if value is not None])
    return held | F.col(quoted(column)).isNull() if None in values else held


def upsert(spark: SparkSession, table: str, source: DataFrame, spec: TableSpec) -> set | None:
    """Merge the source into the table.

    Returns the partitions that may have changed, or None where they are not known.
    """
    provider = _described(spark, f"DESCRIBE TABLE EXTENDED {table}").get("Provider", "").lower()
    if provider != "parquet":
        view = f"incoming_{uuid.uuid4().hex}"
        source.createOrReplaceTempView(view)
        spark.sql(merge_statement(table, view, spec.merge))
        spark.catalog.dropTempView(view)
        return None
    if spec.partitioning is None:
        # Gold results: the source is about as large as the table, its key is the table's
        # primary key and every row differs, so one pass over both is the shortest plan.
        target = spark.table(table)
        incoming = staged(aligned(source, target), **PACKED)
        replace_table(merge_upsert(target, incoming, spec.merge, MergePlan.ONE_PASS), table)
        return None
    return PartitionMerge(spark, table, source, spec).apply()


SIGN = "sign"
FINGERPRINT = "row_fingerprint"


def bucketed(source: DataFrame, spec: TableSpec) -> DataFrame:
    """The source with the folder and the fingerprint of each row."""
    key, held = F.col(quoted(spec.merge.key)), [F.col(quoted(name)) for name in spec.merge.update]
    return source.withColumns(
        {
            spec.partitioning.column: F.pmod(F.xxhash64(key), F.lit(spec.partitioning.buckets)).cast("int"),
            FINGERPRINT: F.unhex(F.md5(F.to_json(F.struct(*held)).cast("binary"))),
        }
    )


class PartitionMerge:
    """An upsert into a table with folders: looked up in one scan of the table, then applied.

    The scan reads the key and the folder (with `whole_rows` all columns) of rows whose key lies
    in the batch's range and in its Bloom filter; only these are shuffled to meet the batch, and
    what matches is written out once. The folders to rewrite, the rows to insert and the images
    all come from that small frame.
    """

    def __init__(
        self, spark: SparkSession, table: str, source: DataFrame, spec: TableSpec, whole_rows: bool = False
    ) -> None:
        self.spark, self.table, self.spec, self.merge = spark, table, spec, spec.merge
        target = spark.table(table)
        self.columns = target.columns
        if spec.partitioning.buckets:
            self.merge = replace(spec.merge, update=(*spec.merge.update, FINGERPRINT))
            source = bucketed(aligned(source, target.select(spec.schema.names)), spec)
        self.incoming = staged(aligned(source, target), **PACKED)
        self.unique, self.inserts = split_source(target, self.incoming, self.merge, repeatable=True)
        if target.isEmpty():
            self.matched = self.unique.limit(0)
            return
        if spec.partitioning.buckets:
            self.unique = staged(self.differing(target), **PACKED)
        self.matched = staged(self.lookup(target, whole_rows), **PACKED)

    def differing(self, target: DataFrame) -> DataFrame:
        """Source rows that are new, or of which any stored row has another fingerprint."""
        key, stamp = F.col(quoted(self.merge.key)), F.col(FINGERPRINT)
        held = target.filter(key.isNotNull()).groupBy(key).agg(F.min(stamp).alias("least"), F.max(stamp).alias("most"))
        same = (F.col("least") == stamp) & (F.col("most") == stamp)
        alike = self.unique.join(held, self.merge.key).filter(same).select(key)
        return self.unique.join(alike, self.merge.key, "left_anti").select(self.columns)

    def lookup(self, target: DataFrame, whole_rows: bool) -> DataFrame:
        """The matched rows of the table, with key and folder or with all columns."""
        key = self.merge.key
        names = self.columns if whole_rows else [key, self.spec.partitioning.column]
        held = target.select([F.col(quoted(name)) for name in names])
        asked = key_filter(self.unique, key)
        if asked is None:
            return held.limit(0)
        near = asked.applied(held)
        if asked.words is None:  # the batch is too large for a filter: hashes tell what it meets
            near = self.meeting(near)
        return near.join(self.unique.select(F.col(quoted(key))), key, "left_semi").select(names)

    def meeting(self, held: DataFrame) -> DataFrame:
        """The rows whose key's hash the batch has. Hashes alone are shuffled; where they are many,
        the rows are left to the join that follows."""
        key = F.col(quoted(self.merge.key))
        hashed = F.xxhash64(key).alias(_HASH)
        wanted = self.unique.select(hashed)
        met = staged(held.select(hashed).join(wanted, _HASH, "left_semi").distinct(), **PACKED)
        number = met.count()
        if not number:
            return held.limit(0)
        return held if number > MOST_MET else held.join(met, F.xxhash64(key) == F.col(_HASH), "left_semi")

    def fresh(self) -> DataFrame:
        """The rows to insert: keys that the table does not hold, and what was set aside."""
        key = self.merge.key
        seen = self.matched.select(F.col(quoted(key))).distinct()
        new = self.unique.join(seen, key, "left_anti").select(self.columns)
        return new.unionAll(self.inserts.select(self.columns))

    def images(self) -> DataFrame:
        """Rows that the upsert takes away (sign -1: as they were) and adds (sign 1: as they will
        be). A matched row that stays as it is has none. Needs `whole_rows`, before `apply`."""
        merge = self.merge
        incoming = self.unique.select(
            F.col(quoted(merge.key)), *[F.col(quoted(name)).alias(f"__new_{name}") for name in merge.update]
        )
        met = self.matched.join(incoming, merge.key)
        changed = F.lit(False)
        for name in merge.update:
            changed = changed | ~F.col(quoted(name)).eqNullSafe(F.col(quoted(f"__new_{name}")))

        def image(sign: int) -> Column:
            after = [f"__new_{name}" if sign > 0 and name in merge.update else name for name in self.columns]
            held = [F.col(quoted(source)).alias(name) for source, name in zip(after, self.columns)]
            return F.struct(*held, F.lit(sign).alias(SIGN))

        both = met.filter(changed).select(F.explode(F.array(image(-1), image(1))).alias("image")).select("image.*")
        return both.unionAll(self.fresh().withColumn(SIGN, F.lit(1)))

    def apply(self) -> set:
        """Rewrite the partitions that hold matched rows, then append the new rows.

        Both steps may be repeated after a failure between them: the first writes the same
        values again, and a new lookup finds the rows already appended, also those of a new key
        that the source holds more than once. Rows without a key are appended again.
        """
        column = self.spec.partitioning.column
        touched = set(_partition_values(self.matched, column))
        if touched:
            old = self.spark.table(self.table).filter(in_values(column, touched))
            replace_partitions(update_matched(old, self.unique, self.merge), self.table, column, touched)
        changed = self.unique.unionAll(self.inserts.select(self.columns)) if self.spec.partitioning.buckets else self.incoming
        folders = _partition_values(changed, column)
        fresh = self.fresh()
        if len(folders) > FEW_FOLDERS or sum(folders.values()) < MANY_ROWS:
            fresh = fresh.hint("rebalance", column)
        fresh.write.insertInto(self.table)
        return touched | set(folders)


def _partition_values(df: DataFrame, column: str) -> dict:
    """Each folder of the table and its rows: bounded by the calendar, not by the data."""
    return {row[0]: row[1] for row in df.groupBy(quoted(column)).count().collect()}
