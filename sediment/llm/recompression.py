"""Substring dedup by recompression: long passages that repeat across documents.

Rounds of recompression name runs of equal symbols and then pairs of neighbours, where a symbol
may only begin or only end a pair, as a hash of its name and the round says. Names are hashes of
what they stand for, so every task gives the same name to the same thing and the rounds need
no shuffle. For each symbol the interval of words that its making depended on is kept: whoever
reads the same words there makes the same symbol at the same place, whatever stands outside.

So two equal windows of `window` words hold the same symbols with intervals inside, and agree on
the highest one, the longest (of equal ones the one whose name hashes highest, then the first).
That symbol is the window's anchor. Windows that follow one another mostly share it, and one
row per anchor goes to Spark: the anchor's name and a 128-bit hash of the stretch of words that
its windows cover.

1. Anchors that one document alone holds are dropped; no window of theirs repeats elsewhere.
2. A stretch that a document with a smaller id holds too is removed as a whole.
3. For anchors with stretches that are alike only in part, the windows of one copy of each
   distinct stretch are compared by 128-bit hashes: this is the verification.
4. Removed words are taken out of the documents, judged on the input.

Counts and joins move hashes; hot names are combined on the map side or split by adaptive
execution. The text is shuffled for steps 3 and 4.

Defined results: a null or empty text has no words; texts shorter than the window lose nothing;
repeats within one document alone are kept; rows that share an id count as one document and
are returned each; rows with a null id lose nothing and count nowhere; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import map_texts, mix, powers, quoted, ranges, split_words, starts_of
from sediment.sinks.staging import staged

ANCHORS = "doc_id long, version long, lo int, hi int, sym long, e1 long, e2 long"
WINDOWS = "doc_id long, version long, pos int, w1 long, w2 long"
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_START_BITS = np.uint64(2**32 - 1)


class Symbols:
    """A level of the parse of several texts: names, word ranges, and what they depend on."""

    def __init__(self, name, start, end, low, high, text) -> None:
        self.name, self.start, self.end, self.low, self.high, self.text = name, start, end, low, high, text

    def neighbours(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of what the symbols before and after each are known by.

        Beyond the ends of its text a symbol depends on what no window holds.
        """
        inner = self.text[1:] == self.text[:-1]
        low, high = begin[self.text] - 1, end[self.text] + 1
        low[1:][inner] = self.low[:-1][inner]
        high[:-1][inner] = self.high[1:][inner]
        return low, high


def _runs(s: Symbols, begin: np.ndarray, end: np.ndarray) -> tuple[Symbols, np.ndarray]:
    """Runs of equal symbols become one; also says which symbols are new."""
    low, high = s.neighbours(begin, end)
    first = np.ones(len(s.name), bool)
    first[1:] = (s.name[1:] != s.name[:-1]) | (s.text[1:] != s.text[:-1])
    heads = np.flatnonzero(first)
    tails = np.append(heads[1:], len(s.name)) - 1
    length = (tails - heads + 1).astype(np.uint64)
    new = length > 1
    name = np.where(new, mix(mix(s.name[heads]) + length), s.name[heads])
    # That a run ends where it does is known by its neighbours.
    return Symbols(name, s.start[heads], s.end[tails], low[heads], high[tails], s.text[heads]), new


def _pairs(s: Symbols, begin: np.ndarray, end: np.ndarray, number: int) -> tuple[Symbols, np.ndarray]:
    """Neighbours that begin and end a pair become one."""
    low, high = s.neighbours(begin, end)
    opens = (mix(s.name + np.uint64(number + 1)) & np.uint64(1)).astype(bool)
    joined = np.zeros(len(s.name) + 1, bool)
    joined[1:-1] = opens[:-1] & ~opens[1:] & (s.text[1:] == s.text[:-1])
    second, first = joined[:-1], joined[1:]
    # A symbol that stays alone is known by the neighbour that did not pair with it.
    own_low = np.where(opens | second, s.low, low)
    own_high = np.where(opens & ~first, high, s.high)
    heads = np.flatnonzero(~second)
    tails = heads + first[heads]
    new = first[heads]
    name = np.where(new, mix(mix(s.name[heads]) * np.uint64(3) + s.name[tails]), s.name[heads])
    return Symbols(name, s.start[heads], s.end[tails], own_low[heads], own_high[tails], s.text[heads]), new


def _cover(top: np.ndarray, first: np.ndarray, last: np.ndarray, value: np.ndarray, window: int) -> None:
    """top[p] = max of the values whose range first..last holds p; ranges are at most `window` long."""
    levels = [top] + [np.zeros(len(top), np.uint64) for _ in range(window.bit_length() - 1)]
    width = last - first + 1
    kind = np.frexp(width)[1] - 1  # the largest power of two in the width
    for k, level in enumerate(levels):
        own = np.flatnonzero(kind == k)
        np.maximum.at(level, first[own], value[own])
        if k:
            np.maximum.at(level, last[own] - (1 << k) + 1, value[own])
    for k in range(len(levels) - 1, 0, -1):
        half, level, below = 1 << (k - 1), levels[k], levels[k - 1]
        np.maximum(below, level, out=below)
        np.maximum(below[half:], level[: len(level) - half], out=below[half:])


def anchors(hashes: np.ndarray, counts: np.ndarray, window: int, rounds: int) -> tuple[np.ndarray, ...]:
    """Of every window start of all texts, in order: place, text, and the name of its anchor."""
    n = len(hashes)
    begin = starts_of(counts)
    end = begin + counts
    text = np.repeat(np.arange(len(counts)), counts)
    places = ranges(begin, np.maximum(counts - window + 1, 0))
    if not len(places):
        return places, places, np.zeros(0, np.uint64), places
    at = np.arange(n)
    level = Symbols(hashes, at, at + 1, at, at + 1, text)
    found: list[Symbols] = []
    for number in range(rounds):
        for step in (_runs, lambda s, b, e: _pairs(s, b, e, number)):
            level, new = step(level, begin, end)
            found.append(Symbols(*(part[new] for part in vars(level).values())))
    names = np.concatenate([s.name for s in found])
    start, stop, low, high, owner = (
        np.concatenate([getattr(s, part) for s in found]) for part in ("start", "end", "low", "high", "text")
    )
    top = np.zeros(n, np.uint64)

    def paint(name, start, stop, low, high, owner) -> None:
        first, last = np.maximum(high - window, begin[owner]), np.minimum(low, end[owner] - window)
        own = np.flatnonzero(first <= last)
        length = np.minimum(stop[own] - start[own], 63).astype(np.uint64)
        value = (length << np.uint64(58)) | ((mix(name[own]) >> np.uint64(38)) << np.uint64(32))
        _cover(top, first[own], last[own], value | (_START_BITS - start[own].astype(np.uint64)), window)

    paint(names, start, stop, low, high, owner)
    if (top[places] == 0).any():  # single words depend on themselves only: every window holds some
        paint(hashes, at, at + 1, at, at + 1, text)
    return places, text[places], top[places], begin[text[places]]


class RangeHashes:
    """128-bit hashes of short ranges of words: symbols and windows."""

    def __init__(self, hashes: np.ndarray) -> None:
        n = len(hashes) + 1
        inverse = np.full(n, _BASE_INVERSE)
        inverse[0] = 1
        self.inverse, power = np.cumprod(inverse), powers(n)[:-1]
        self.sums = [
            np.concatenate((np.zeros(1, np.uint64), np.cumsum(own * power)))
            for own in (hashes, mix(hashes + np.uint64(0xC2B2AE3D27D4EB4F)))
        ]

    def of(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = (end - start).astype(np.uint64)
        return tuple(mix((s[end] - s[start]) * self.inverse[start] + size).view(np.int64) for s in self.sums)


def stretch_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of the 128-bit XXH3 of each range of words. Stretches may be long, where sums of
    powers modulo 2 ** 64 can be made to collide."""
    held = memoryview(np.ascontiguousarray(hashes)).cast("B")
    digests = [xxhash.xxh3_128_digest(held[a:b]) for a, b in zip((8 * start).tolist(), (8 * end).tolist(), strict=True)]
    halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1])


def anchor_rows(docs: DataFrame, window: int, rounds: int) -> DataFrame:
    """ANCHORS of a frame with doc_id, version and text: windows lo..hi share the anchor sym."""

    def run(batch, texts):
        words = split_words(texts)
        places, text, top, begin = anchors(words.hashes, words.counts, window, rounds)
        head = np.ones(len(places), bool)
        head[1:] = (top[1:] != top[:-1]) | (text[1:] != text[:-1])
        heads = np.flatnonzero(head)
        tails = np.append(heads[1:], len(places))[: len(heads)] - 1
        lo, hi = places[heads], places[tails]
        hashed = RangeHashes(words.hashes)
        start = (_START_BITS - (top[heads] & _START_BITS)).astype(np.int64)
        sym, _ = hashed.of(start, start + (top[heads] >> np.uint64(58)).astype(np.int64))
        e1, e2 = stretch_hashes(words.hashes, lo, hi + window)
        which = pa.array(text[heads])
        columns = [
            batch.column(0).take(which),
            batch.column(1).take(which),
            pa.array(lo - begin[heads], pa.int32()),
            pa.array(hi - begin[heads], pa.int32()),
            *map(pa.array, (sym, e1, e2)),
        ]
        yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in ANCHORS.split(", ")])

    return map_texts(docs, "text", run, ANCHORS)


def window_rows(docs: DataFrame, window: int) -> DataFrame:
    """WINDOWS of the ranges in the columns lo and hi (arrays)."""

    def run(batch, texts):
        words = split_words(texts)
        begin = starts_of(words.counts)
        lo, hi = batch.column("lo"), batch.column("hi")
        counts = np.array([len(own) for own in lo.to_pylist()], np.int64)
        owner = np.repeat(np.arange(len(texts)), counts)
        first = lo.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        widths = hi.flatten().to_numpy(zero_copy_only=False).astype(np.int64) - first + 1
        owner, pos = np.repeat(owner, widths), ranges(first, widths)
        w1, w2 = RangeHashes(words.hashes).of(begin[owner] + pos, begin[owner] + pos + window)
        which = pa.array(owner)
        columns = [batch.column("doc_id").take(which), batch.column("version").take(which)]
        columns += [pa.array(pos, pa.int32()), pa.array(w1), pa.array(w2)]
        yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in WINDOWS.split(", ")])

    return map_texts(docs, "text", run, WINDOWS)


def _with_ranges(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """The documents with their ranges lo..hi as two arrays."""
    held = rows.groupBy(F.col("doc_id").alias("of"), F.col("version").alias("of_version")).agg(
        F.collect_list(F.struct("lo", "hi")).alias("held")
    )
    same = (F.col("doc_id") == F.col("of")) & (F.col("version") == F.col("of_version"))
    return docs.join(held, same, how).select(*docs.columns, F.col("held.lo").alias("lo"), F.col("held.hi").alias("hi"))


def repeated_ranges(docs: DataFrame, window: int, rounds: int) -> DataFrame:
    """doc_id, version, lo, hi: ranges of window starts that repeat from a smaller doc_id."""
    rows = staged(anchor_rows(docs.filter("doc_id is not null"), window, rounds))
    shared = staged(
        rows.groupBy("sym")
        .agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
        .filter("first_doc < last_doc")
        .drop("last_doc")
    )
    rows = staged(rows.join(shared, "sym"))
    stretches = staged(rows.groupBy("sym", "e1", "e2").agg(F.min("doc_id").alias("held_by")))
    rows = staged(rows.join(stretches, ["sym", "e1", "e2"]))
    whole = rows.filter("held_by < doc_id").select("doc_id", "version", "lo", "hi")
    first_copies = rows.filter("held_by = doc_id")
    in_part = staged(first_copies.filter("first_doc < doc_id").select("sym").distinct())
    compared = first_copies.join(in_part, "sym").select("doc_id", "version", "lo", "hi")
    windows = staged(window_rows(_with_ranges(docs, compared, "inner"), window))
    earliest = staged(
        windows.groupBy("w1", "w2")
        .agg(F.min("doc_id").alias("held_by"), F.max("doc_id").alias("last_doc"))
        .filter("held_by < last_doc")
        .drop("last_doc")
    )
    single = (
        windows.join(earliest, ["w1", "w2"])
        .filter("held_by < doc_id")
        .select("doc_id", "version", F.col("pos").alias("lo"), F.col("pos").alias("hi"))
    )
    return whole.union(single)


def substring_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = 50,
    rounds: int = 5,
) -> DataFrame:
    """doc_id, kept_text (words joined by one space), n_words (before), n_removed."""
    source = docs.select(
        F.col(quoted(id_column)).cast("long").alias("doc_id"), F.col(quoted(text_column)).alias("text")
    ).withColumn("version", F.xxhash64("text"))
    source = source.select("doc_id", "version", "text")
    marked = _with_ranges(source, repeated_ranges(source, window, rounds), "left")

    def run(batch, texts):
        kept, counts, removed = [], [], []
        for text, lo, hi in zip(texts, batch.column("lo").to_pylist(), batch.column("hi").to_pylist(), strict=True):
            words = text.split()
            counts.append(len(words))
            if lo:
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, np.array(lo), 1)
                np.add.at(change, np.array(hi) + window, -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
            removed.append(counts[-1] - len(words))
            kept.append(b" ".join(words))
        columns = [batch.column(0), pa.array(kept, pa.binary()).cast(pa.string())]
        columns += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kept_text", "n_words", "n_removed"])

    return map_texts(marked, "text", run, "doc_id long, kept_text string, n_words long, n_removed long")
