"""Fold the deliveries of several days into one source for a single upsert.

Merged one after another, the days of a batch leave each key with the columns that an upsert
does not overwrite as its earliest day delivered them (if the table does not hold the key
already), and the overwritten ones as its latest day did. Both are ordered aggregates over one
shuffle, so the table is looked up once for any number of days.

A key that comes once is its own fold. Hashes of all keys are counted first, which shuffles a few
bytes a key, and only rows whose hash repeats are shuffled as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sediment.operators.keys import quoted
from sediment.operators.upsert import MergeConflict, MergeSpec
from sediment.sinks.staging import PACKED, staged

_HASH = "__hash"
_FIRST, _LAST, _EARLIEST, _LATEST, _ROWS, _DAYS = "__first", "__last", "__earliest", "__latest", "__rows", "__days"


def _repeated_hashes(keyed: DataFrame, key: Column) -> tuple[DataFrame | None, bool]:
    """Hashes that more than one row's key has, and whether they hold most of the rows."""
    hashes = keyed.groupBy(F.xxhash64(key).alias(_HASH)).agg(F.count(F.lit(1)).alias(_ROWS))
    repeats = F.col(_ROWS) > 1
    seen = Observation()
    totals = F.sum(_ROWS).alias("rows"), F.sum(F.when(repeats, F.col(_ROWS)).otherwise(0)).alias("shared")
    suspects = staged(hashes.observe(seen, *totals).filter(repeats).select(_HASH), **PACKED)
    total, shared = seen.get["rows"] or 0, seen.get["shared"] or 0
    return (suspects if shared else None), 2 * shared > total


def fold_days(rows: DataFrame, day: str, spec: MergeSpec) -> DataFrame:
    """One source with the effect of merging the days in order; `day` is dropped.

    Rows without a key are all kept. A key that one day delivers more than once is a conflict if
    an earlier day delivers it too (`MergeConflict`); else all its rows are kept, with the
    columns to overwrite from its latest day, and the upsert decides: it inserts them, unless
    the table holds the key. Reads the rows several times: stage them first.
    """
    columns = [name for name in rows.columns if name != day]
    kept = [name for name in columns if name != spec.key and name not in spec.update]
    key, on = F.col(quoted(spec.key)), F.col(quoted(day))
    keyed, settled_rows = rows.filter(key.isNotNull()), rows.filter(key.isNull()).select(columns)
    suspects, most = _repeated_hashes(keyed, key)
    if suspects is None:
        return rows.select(columns)
    if not most:
        alike = F.xxhash64(key) == F.col(_HASH)
        settled_rows = keyed.join(suspects, alike, "left_anti").select(columns).unionAll(settled_rows)
        keyed = staged(keyed.join(suspects, alike, "left_semi"), **PACKED)

    def held(names: list[str]):
        return F.struct(*[F.col(quoted(name)) for name in names]) if names else F.struct(F.lit(0).alias("none"))

    folded = staged(
        keyed.groupBy(key).agg(
            F.min_by(held(kept), on).alias(_EARLIEST),
            F.max_by(held(list(spec.update)), on).alias(_LATEST),
            F.min(on).alias(_FIRST),
            F.max(on).alias(_LAST),
            F.count(F.lit(1)).alias(_ROWS),
            F.size(F.collect_set(on)).alias(_DAYS),  # as many as the batch has days at most
        ),
        **PACKED,
    )
    source = {name: F.col(f"{_EARLIEST}.{quoted(name)}") for name in kept}
    source |= {name: F.col(f"{_LATEST}.{quoted(name)}") for name in spec.update}
    source[spec.key] = key
    single = folded.filter(F.col(_ROWS) == F.col(_DAYS))
    result = single.select([source[name].alias(name) for name in columns]).unionAll(settled_rows)
    repeated = folded.filter(F.col(_ROWS) > F.col(_DAYS)).select(key, _FIRST, _LAST, _LATEST)
    if repeated.isEmpty():
        return result
    copies = staged(keyed.join(repeated, spec.key), **PACKED)
    clash = copies.filter(on > F.col(_FIRST)).groupBy(key, on).count().filter("count > 1").first()
    if clash is not None:
        raise MergeConflict(f"more than one row of {clash[1]} has {spec.key} = {clash[0]}")
    later = F.col(_LAST) > F.col(_FIRST)
    settled = {name: F.when(later, source[name]).otherwise(F.col(quoted(name))) for name in spec.update}
    first = copies.filter(on == F.col(_FIRST))
    return result.unionAll(first.select([settled.get(name, F.col(quoted(name))).alias(name) for name in columns]))
