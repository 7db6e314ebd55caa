"""Key-based building blocks shared by the upsert, the price append and the coverage check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.sinks.staging import staged

# A Bloom filter of at most 2 ** 18 words of 64 bits: 4 MB of rows, whatever the data.
MOST_WORDS = 1 << 18
KEYS_PER_WORD = 4
_WORD, _BITS = "__word", "__bits"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _same_key(left: str, right: str, keys: Sequence[str], null_safe: bool) -> Column:
    condition = F.lit(True)
    for key in keys:
        a, b = F.col(f"{left}.{quoted(key)}"), F.col(f"{right}.{quoted(key)}")
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return condition


def seen_keys(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Distinct keys of `source` that `target` holds.

    Only the key columns of the (large) target are read. If the source keys can be broadcast,
    the optimizer moves the semi join below the target's `distinct`, and the target is not
    shuffled. If not, both sides are first made distinct (combined on the map side), so that
    a key repeated any number of times on either side never gathers in one task.
    """
    columns = [F.col(quoted(key)) for key in keys]
    wanted = source.select(columns).distinct()
    held = target.select(columns).distinct()
    return held.alias("held").join(
        wanted.alias("wanted"), _same_key("held", "wanted", keys, null_safe), "left_semi"
    )


def unseen(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    small_source: bool = False,
) -> DataFrame:
    """Rows of `source` whose key is not in `target`.

    By default the distinct target keys are shuffled to the source, the shorter plan when
    both have a similar size. `small_source` first reduces the target to the keys the source
    asks for, which spares a large target the shuffle.

    With plain equality a NULL key is never in the target; those rows skip the join, where
    they would all land in one partition.
    """
    if small_source:
        held = seen_keys(target, source, keys, null_safe)
    else:
        held = target.select([F.col(quoted(key)) for key in keys]).distinct()
    if null_safe:
        joinable, keyless = source, None
    else:
        has_null = F.lit(False)
        for key in keys:
            has_null = has_null | F.col(quoted(key)).isNull()
        joinable, keyless = source.filter(~has_null), source.filter(has_null)
    fresh = joinable.alias("fresh").join(
        held.alias("seen"), _same_key("fresh", "seen", keys, null_safe), "left_anti"
    )
    return fresh if keyless is None else fresh.unionAll(keyless)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Keep one row per key, the first in the given order; NULL keys form a group of their own.

    Spark limits each group before the shuffle as well as after it (WindowGroupLimit), so a
    hot key sends at most one row per map task.
    """
    rank = "__rank"
    window = Window.partitionBy(*[quoted(key) for key in keys]).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def _bloom_word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _bloom_mask(key: Column) -> Column:
    """Two of a word's bits, chosen by a second hash."""
    chosen = F.xxhash64(F.lit(1), key)
    bits = (chosen.bitwiseAND(F.lit(63)), F.shiftright(chosen, 6).bitwiseAND(F.lit(63)))
    one = F.lit(1).cast("bigint")
    first, second = (F.call_function("shiftleft", one, bit.cast("int")) for bit in bits)
    return first.bitwiseOR(second)


@dataclass(frozen=True)
class KeyFilter:
    """What a scan must know about a batch of keys to drop most rows that it does not ask for.

    The least and the greatest key are plain comparisons, which reach the file scan and skip
    row groups. Inside that range a Bloom filter (two bits in one 64-bit word a key) drops all
    but a few per cent of the other keys. Its words are a small table of a size that is bounded
    by `MOST_WORDS`, so it may be broadcast whatever the sizes of batch and table. A batch too
    large for it has the range only.
    """

    key: str
    least: object
    greatest: object
    words: DataFrame | None
    number: int

    def applied(self, rows: DataFrame) -> DataFrame:
        """The rows whose key may be in the batch: all that are, and few others."""
        key = F.col(quoted(self.key))
        near = rows.filter(key.between(F.lit(self.least), F.lit(self.greatest)))
        if self.words is None:
            return near
        mask = _bloom_mask(key)
        held = (_bloom_word(key, self.number) == F.col(_WORD)) & (F.col(_BITS).bitwiseAND(mask) == mask)
        return near.join(F.broadcast(self.words), held, "left_semi")


def key_filter(batch: DataFrame, key: str) -> KeyFilter | None:
    """The filter of a batch's keys, from two small jobs over it; None if it has no keys."""
    column = F.col(quoted(key))
    least, greatest, number = batch.agg(F.min(column), F.max(column), F.count(column)).first()
    if not number:
        return None
    words = 1 << max(0, -(-number // KEYS_PER_WORD) - 1).bit_length()
    if words > MOST_WORDS * 4:  # nearly all bits would be set
        return KeyFilter(key, least, greatest, None, 0)
    words = min(words, MOST_WORDS)
    held = batch.filter(column.isNotNull()).groupBy(_bloom_word(column, words).alias(_WORD))
    return KeyFilter(key, least, greatest, staged(held.agg(F.bit_or(_bloom_mask(column)).alias(_BITS))), words)
