"""Key-based upsert with the rules of SQL MERGE, for frames in any file format.

    MERGE INTO target USING source ON target.key = source.key
    WHEN MATCHED THEN UPDATE SET <some columns>
    WHEN NOT MATCHED THEN INSERT *

Rows that cannot match are set aside before any join, where they would all land in one
task: rows with a NULL key, which equals nothing, and source rows whose key repeats, which
either clash with a target row (an error) or are all inserted. Every remaining source key is
unique. Three plans for the rest give the same result:

ONE_PASS      a full outer join. Each side is read and shuffled once. For a target whose key
              is (nearly) unique, such as a primary key.
HOT_TARGET    a left join for the updates and an anti join for the inserts. Adaptive
              execution can split a target key that fills many tasks, which it cannot do in
              a full outer join; the target's key column is read a second time.
SMALL_SOURCE  as HOT_TARGET, but the anti join only meets the target keys that the source
              asks for. A source below the broadcast threshold moves no target row.
"""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.operators.keys import quoted, unseen
from sediment.sinks.staging import staged

_STORED = "__stored"
_INCOMING = "__incoming"
_NEW = "__new_"


class MergePlan(Enum):
    ONE_PASS = "one_pass"
    HOT_TARGET = "hot_target"
    SMALL_SOURCE = "small_source"


@dataclass(frozen=True)
class MergeSpec:
    """Key column and the columns overwritten on a match; all other columns are kept."""

    key: str
    update: tuple[str, ...]


class MergeConflict(ValueError):
    """More than one source row matches the same target row."""


def aligned(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source columns by target name, in target order and type; a missing one is an error."""
    return source.select(
        [F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )


def _key_hash(key: Column) -> Column:
    return F.xxhash64(key)


def _repeated_keys(keyed: DataFrame, key: Column) -> DataFrame | None:
    """Keys of more than one row. Hashes are counted first, which shuffles 8 bytes a key;
    the keys themselves only where a hash repeats."""
    hashes = keyed.groupBy(_key_hash(key).alias("hash")).agg(F.count(F.lit(1)).alias("copies"))
    most = hashes.agg(F.max("copies")).first()[0]
    if most is None or most == 1:
        return None
    suspects = staged(hashes.filter("copies > 1").select("hash"))
    alike = keyed.select(key).join(suspects, _key_hash(key) == F.col("hash"), "left_semi")
    return staged(alike.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select(key))


def split_source(
    target: DataFrame, source: DataFrame, spec: MergeSpec, repeatable: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Divide the source into rows with a unique key and rows to insert unseen.

    Runs a job that counts keys (combined on the map side). Normally none repeats. If some
    do, they are written out, and raise `MergeConflict` when the target holds one of them.
    With `repeatable`, repeated keys of which the target holds exactly the source's rows are
    left out instead: an earlier try of the same merge has inserted them.
    """
    key = F.col(quoted(spec.key))
    keyed, keyless = source.filter(key.isNotNull()), source.filter(key.isNull())
    repeated = _repeated_keys(keyed, key)
    if repeated is None:
        return keyed, keyless
    copies = keyed.join(repeated, spec.key, "left_semi").select(source.columns)
    if repeatable:
        stored = staged(target.select(source.columns).join(repeated, spec.key, "left_semi").select(source.columns))
        held = stored.select(key).distinct()
        asked = copies.join(held, spec.key, "left_semi").select(source.columns)
        clash = stored.exceptAll(asked).unionAll(asked.exceptAll(stored)).select(key).first()
        copies = copies.join(held, spec.key, "left_anti").select(source.columns)
    else:
        clash = target.select(key).join(repeated, spec.key, "left_semi").first()
    if clash is not None:
        raise MergeConflict(f"more than one source row matches {spec.key} = {clash[0]}")
    return keyed.join(repeated, spec.key, "left_anti").select(source.columns), keyless.unionAll(copies)


def _meet(target: DataFrame, unique_source: DataFrame, spec: MergeSpec, how: str) -> DataFrame:
    """Target rows with a key joined to the source, and each column settled."""
    key = F.col(quoted(spec.key))
    names = [c for c in target.columns if c != spec.key]
    if how == "left":
        names = [c for c in names if c in spec.update]
    incoming = unique_source.select(
        key, F.lit(True).alias(_INCOMING), *[F.col(quoted(c)).alias(_NEW + c) for c in names]
    )
    stored = target.filter(key.isNotNull()).withColumn(_STORED, F.lit(True))
    joined = stored.join(incoming, spec.key, how)

    def settled(name: str):
        old = F.col(quoted(name))
        if name not in names:
            return old
        new = F.col(quoted(_NEW + name))
        take_new = F.col(_INCOMING) if name in spec.update else F.col(_STORED).isNull()
        return F.when(take_new, new).otherwise(old).alias(name)

    return joined.select([settled(name) for name in target.columns])


def update_matched(target: DataFrame, unique_source: DataFrame, spec: MergeSpec) -> DataFrame:
    """All target rows, with the update columns taken from the source where the key matches."""
    return _meet(target, unique_source, spec, "left").unionAll(
        target.filter(F.col(quoted(spec.key)).isNull())
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    spec: MergeSpec,
    plan: MergePlan = MergePlan.HOT_TARGET,
) -> DataFrame:
    """The target after the merge.

    Runs a job over the source's keys when it is called (`split_source`). The source is read
    several times: stage it first if it is costly to compute.
    """
    incoming = aligned(source, target)
    unique, inserts = split_source(target, incoming, spec)
    if plan is MergePlan.ONE_PASS:
        keyless = target.filter(F.col(quoted(spec.key)).isNull())
        return _meet(target, unique, spec, "full").unionAll(keyless).unionAll(inserts)
    fresh = unseen(unique, target, [spec.key], small_source=plan is MergePlan.SMALL_SOURCE)
    return update_matched(target, unique, spec).unionAll(fresh).unionAll(inserts)
