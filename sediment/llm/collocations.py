"""Phrase collocations by SETM: relational mining over sorted occurrence relations.

The occurrence relation is persisted in parts: a part holds some megabytes of text of one
language, its occurrences sorted by piece and position, packed as one compressed array of codes
with -1 between pieces. A code is local to the part; beside the array lie the part's distinct entries
(code -> word, or the pair of shorter phrases) and how often each occurs. One length is mined
like this:

1. group-count: the entries of all parts are dealt by group and their counts summed. A hot
   phrase has one entry per part, so no group is large. Words travel as rows. Pairs of phrases,
   nearly as many as there are words, travel as one row per part and bucket, packed in order of
   their groups; a task counts one bucket, and the number of buckets grows with the text.
2. semi-join: entries of frequent groups return to their part with the name of the group,
   packed by part.
3. merge-join: in each part, neighbours in the sorted array that are both frequent are joined
   into the phrase that is one word longer (its first and its last words overlap), which gives
   the next relation and its entries. Both shorter phrases of a longer frequent one are
   frequent, so nothing is lost.

What is kept for the next length is the relation before its join, without what cannot be joined:
it takes fewer bits than the joined one, which the next length makes again from it.

A group is named by its smallest (part, code), so names are exact, not hashes. No frequent
set is broadcast by us, and a task holds one part or one bucket.

The association score of a phrase cut after its first k words is
floor(2000000 * a / (l + r)), with a, l, r the counts of the phrase and of its two sides; the
cut with the lowest score counts, the smallest k of equals. A phrase is absorbed by a longer
one that holds it and has `absorbed_percent` of its count: any such phrase contains one that is
longer by a single word, at least as frequent, so only those are compared.

Defined results: null texts hold no words; a null language is `und`; repeated rows count as
often as they occur; ids play no part; equal scores go to the larger count, then to the smaller
phrase in byte order; a text of any length is cut between pieces, so only a piece is held
whole; an empty table, or one without frequent phrases, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.common import arrow_map, mix, narrowed, ship, starts_of
from sediment.sinks.staging import staged

UNKNOWN = "und"
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
PART_BYTES = 16 << 20
HELD_BYTES = 48 << 20
NAMES_AT_ONCE = 1 << 18
BUCKET_WORDS = 2 << 20  # words of all texts for each bucket of entries
LEAST_BUCKETS = 16
# Files of relations: codes and sorted ids are delta encoded, which the writer's version 1 does not do.
DENSE = {"parquet.writer.version": "v2", "compression": "zstd"}
COUNTER_BITS = 13  # parts of one task
CODE_BITS = 28  # distinct entries of one part
FIRST = "part long, lang string, words long, symbols binary, code int, word binary, held long"
NEXT = "part long, symbols binary, ids binary, bucket int, start int, entries binary"
FOUND = "id long, first long, second long, f long, part long, names binary"

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(BREAKS)] = 2


def pieces_of(text: bytes, limit: int = PART_BYTES) -> Iterator[bytes]:
    """The text in stretches of about `limit` bytes, cut at breaks only."""
    start = 0
    while len(text) - start > limit:
        cut = max(text.rfind(bytes([mark]), start, start + limit) for mark in BREAKS)
        if cut < 0:
            found = [at for mark in BREAKS if (at := text.find(bytes([mark]), start)) >= 0]
            if not found:
                break
            cut = min(found)
        yield text[start : cut + 1]
        start = cut + 1
    yield text[start:]


def packed(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes in order with -1 between pieces; the distinct words; how often each occurs.

    Frequent words have the small codes, which are the shorter ones when compressed.
    """
    buffer = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)  # bytes: only A-Z change
    kind = _KIND[buffer]
    edges = np.flatnonzero(np.diff(kind == 0, prepend=False))
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    data = buffer[kind == 0]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    broken = np.flatnonzero(np.diff(piece)) + 1
    held = np.bincount(codes, minlength=len(coded.dictionary))
    order = np.argsort(-held, kind="stable")
    symbols = np.insert(places(order)[codes], broken, -1)
    return symbols, coded.dictionary.cast(pa.binary()).take(pa.array(order)), held[order]


def places(order: np.ndarray) -> np.ndarray:
    """Where each element comes in the given order."""
    found = np.empty(len(order), "<i4")
    found[order] = np.arange(len(order))
    return found


def known_only(symbols: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A relation of what can be joined: codes with an id (not -1) beside another such code.

    The new code is the place of the id among the part's own, which are returned sorted.
    """
    known = np.append(ids >= 0, False)[symbols]  # -1 stands for the last
    beside = known[:-1] & known[1:]
    kept = np.append(beside, False) | np.append(False, beside)
    used = np.zeros(len(ids), bool)
    used[symbols[kept]] = True
    codes = np.flatnonzero(used)
    codes = codes[np.argsort(ids[codes])]
    place = np.full(len(ids) + 1, -1, "<i4")
    place[codes] = np.arange(len(codes))
    return np.where(kept, place[symbols], -1)[kept | np.append(False, kept[:-1])], ids[codes]


def joined(
    symbols: np.ndarray, ids: np.ndarray, buckets: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join of a part's sorted relation with itself at the next position.

    Codes of the joined neighbours (-1 where there are none, in a row once); of the distinct
    pairs, the ids of both sides and how often each occurs; and how many pairs each bucket has.
    Codes follow the buckets and in them the two ids, so equal input gives equal codes.
    """
    at = np.flatnonzero((symbols[:-1] >= 0) & (symbols[1:] >= 0))
    pairs, code, held = np.unique(
        symbols[at].astype(np.int64) * len(ids) + symbols[at + 1], return_inverse=True, return_counts=True
    )
    first, second = ids[pairs // len(ids)], ids[pairs % len(ids)]
    bucket = (mix(mix(first.view(np.uint64)) + second.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    result = np.full(len(symbols), -1, "<i4")
    result[at] = places(order)[code]
    present = result >= 0
    result = result[present | np.append(False, present[:-1])]
    return result, first[order], second[order], held[order], np.bincount(bucket, minlength=buckets)


def pressed(*columns: np.ndarray) -> bytes:
    """Arrays of one length byte plane by byte plane, compressed: upper bytes are mostly alike."""
    planes = [column.view(np.uint8).reshape(len(column), -1).T.tobytes() for column in columns]
    return zstandard.compress(b"".join(planes), 1)


def unpressed(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    widths = [np.dtype(kind).itemsize for kind in kinds]
    ends = np.cumsum(widths) * (len(raw) // sum(widths))
    return [
        np.ascontiguousarray(plane.reshape(width, -1).T).view(kind).ravel()
        for plane, width, kind in zip(np.split(raw, ends[:-1]), widths, kinds, strict=True)
    ]


def pressed_symbols(symbols: np.ndarray) -> bytes:
    return pressed((symbols + 1).astype("<i4"))


def unpressed_symbols(data: bytes) -> np.ndarray:
    return unpressed(data, "<i4")[0] - 1


def pressed_entries(first: np.ndarray, second: np.ndarray, held: np.ndarray) -> bytes:
    """Entries in order of their first id, which is kept as steps."""
    return pressed(np.diff(first, prepend=0).astype("<i8"), second.astype("<i8"), held.astype("<i4"))


def unpressed_entries(data: bytes) -> list[np.ndarray]:
    steps, second, held = unpressed(data, "<i8", "<i8", "<i4")
    return [np.cumsum(steps), second, held]


def pressed_names(codes: np.ndarray, ids: np.ndarray) -> bytes:
    return pressed(codes.astype("<i4"), ids.astype("<i8"))


def _state(part: int, symbols: np.ndarray, known: dict, schema: str) -> pa.RecordBatch:
    """The row that holds a part's relation."""
    return _rows(schema, 1, {"part": [part], "symbols": [pressed_symbols(symbols)], **known})


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _rows(schema: str, n: int, known: dict) -> pa.RecordBatch:
    """A batch of n rows with the known columns; the others are null."""
    fields = [field.split() for field in schema.split(", ")]
    columns = [
        pa.array(known[name], _TYPES[kind]) if name in known else pa.nulls(n, _TYPES[kind]) for name, kind in fields
    ]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


def _parts(docs: DataFrame) -> DataFrame:
    """FIRST: a row per part with its relation, and a row per part and distinct word."""

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def flushed(lang):
            nonlocal number
            symbols, words, held = packed(waiting.pop(lang))
            sizes.pop(lang)
            if not len(words):
                return
            if number >> COUNTER_BITS or len(words) >> CODE_BITS:
                raise OverflowError("a task holds too much text")
            part = (task << COUNTER_BITS) + number
            number += 1
            yield _state(part, symbols, {"lang": [lang], "words": [int(held.sum())]}, FIRST)
            n = len(words)
            yield _rows(
                FIRST,
                n,
                {
                    "part": np.full(n, part),
                    "lang": pa.DictionaryArray.from_arrays(np.zeros(n, np.int32), [lang]).cast(pa.string()),
                    "code": np.arange(n, dtype=np.int32),
                    "word": words,
                    "held": held,
                },
            )

        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column("text")[row].as_py()
                if not text:
                    continue
                lang = batch.column("lang")[row].as_py()
                lang = UNKNOWN if lang is None else lang
                for piece in pieces_of(text):
                    waiting.setdefault(lang, []).append(piece)
                    sizes[lang] = sizes.get(lang, 0) + len(piece)
                    if sizes[lang] >= PART_BYTES:
                        yield from flushed(lang)
                    elif sum(sizes.values()) >= HELD_BYTES:
                        yield from flushed(max(sizes, key=sizes.get))
        for lang in list(waiting):
            yield from flushed(lang)

    return staged(arrow_map(docs, run, FIRST), **DENSE)


def _name():
    return F.shiftleft("part", CODE_BITS) + F.col("code")


def _frequent_words(entries: DataFrame, min_count: int) -> DataFrame:
    """name, id: the entries of frequent words and their group; lang, word and f stand where both are equal.

    Counting and the semi-join are one pass over the entries dealt and sorted by their group,
    which has a row per part at most.
    """
    keys = ["lang", "word"]
    group = Window.partitionBy(*keys)
    counted = entries.select(_name().alias("name"), "held", *keys).withColumns(
        {"f": F.sum("held").over(group), "id": F.min("name").over(group)}
    )
    first = F.col("name") == F.col("id")
    return staged(
        counted.filter(F.col("f") >= min_count).select(
            "name", "id", *[F.when(first, F.col(column)).alias(column) for column in (*keys, "f")]
        )
    )


def _frequent_pairs(entries: DataFrame, min_count: int, groups_only: bool) -> DataFrame:
    """FOUND: a row per frequent pair of phrases, and a row per part and bucket with the names of
    the frequent entries, unless only groups are wanted."""

    def run(packed: pa.Table) -> pa.Table:
        packed = packed.sort_by("part")  # names rise: the first of a group is its id
        columns = [unpressed_entries(data.as_py()) for data in packed.column("entries")]
        first, second, held = (np.concatenate(each) for each in zip(*columns, strict=True))
        lengths = np.array([len(column[0]) for column in columns])
        parts, begins = packed.column("part").to_numpy(), packed.column("start").to_numpy()
        offsets = starts_of(lengths)
        name = np.repeat((parts << CODE_BITS) + begins - offsets, lengths) + np.arange(len(first))
        order = np.lexsort((second, first))
        first, second = first[order], second[order]
        new = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        starts = np.flatnonzero(new)
        f = np.add.reduceat(held[order], starts, dtype=np.int64)
        frequent = f >= min_count
        ids, n = name[order[starts]], int(frequent.sum())
        groups = {"id": ids, "first": first[starts], "second": second[starts], "f": f}
        rows = [_rows(FOUND, n, {column: values[frequent] for column, values in groups.items()})]
        if not groups_only:
            own = np.empty(len(order), np.int64)
            own[order] = np.where(frequent, ids, -1)[np.cumsum(new) - 1]
            for part, begin, a, length in zip(parts, begins, offsets, lengths, strict=True):
                at = np.flatnonzero(own[a : a + length] >= 0)
                if len(at):
                    rows.append(_rows(FOUND, 1, {"part": [part], "names": [pressed_names(begin + at, own[a + at])]}))
        return pa.Table.from_batches(rows)

    ship(entries.sparkSession)
    return staged(entries.select("part", "bucket", "start", "entries").groupBy("bucket").applyInArrow(run, FOUND))


def _names_by_part(found: DataFrame) -> DataFrame:
    """part, names: names of entries packed by part, which makes few rows to shuffle."""

    def packed_rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        name, ids = (table.column(column).to_numpy() for column in ("name", "id"))
        order = np.argsort(name)
        name, ids = name[order], ids[order]
        part = name >> CODE_BITS
        code = name & ((1 << CODE_BITS) - 1)
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        ends = [*starts[1:].tolist(), len(part)]
        bounds = list(zip(starts.tolist(), ends))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(part[starts]),
                pa.array([pressed_names(code[a:b], ids[a:b]) for a, b in bounds], pa.binary()),
            ],
            ["part", "names"],
        )

    def run(batches):
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= NAMES_AT_ONCE:
                yield packed_rows(held)
                held, count = [], 0
        if count:
            yield packed_rows(held)

    return arrow_map(found.select("name", "id"), run, "part long, names binary")


def _extended(states: DataFrame, names: DataFrame, buckets: int, last: bool) -> DataFrame:
    """NEXT: a row per part with the relation that was joined, if it is needed again, and a row per
    part and bucket with the entries of the longer phrases."""

    def run(state: pa.Table, names: pa.Table) -> pa.Table:
        schema = pa.schema([(name, _TYPES[kind]) for name, kind in (field.split() for field in NEXT.split(", "))])
        if not names.num_rows or not state.num_rows:
            return schema.empty_table()
        symbols = unpressed_symbols(state.column("symbols")[0].as_py())
        part = state.column("part")[0].as_py()
        shorter = state.column("ids")[0].as_py()
        if shorter is not None:
            symbols = joined(symbols, np.cumsum(unpressed(shorter, "<i8")[0]), buckets)[0]
        ids = np.full(int(symbols.max(initial=0)) + 1, -1, np.int64)
        for data in names.column("names"):
            codes, own = unpressed(data.as_py(), "<i4", "<i8")
            ids[codes] = own
        symbols, ids = known_only(symbols, ids)
        if not len(symbols):
            return schema.empty_table()
        _, first, second, held, sizes = joined(symbols, ids, buckets)
        starts = starts_of(sizes)
        filled = np.flatnonzero(sizes)
        entries = {
            "part": np.full(len(filled), part),
            "bucket": filled.astype(np.int32),
            "start": starts[filled].astype(np.int32),
            "entries": [
                pressed_entries(first[a:b], second[a:b], held[a:b])
                for a, b in zip(starts[filled].tolist(), (starts + sizes)[filled].tolist(), strict=True)
            ],
        }
        rows = [_rows(NEXT, len(filled), entries)]
        if not last:
            own = {"ids": [pressed(np.diff(ids, prepend=0).astype("<i8"))]}
            rows.insert(0, _state(part, symbols, own, NEXT))
        return pa.Table.from_batches(rows)

    ship(states.sparkSession)
    kept = states.select("part", "symbols", "ids").groupBy("part")
    return staged(kept.cogroup(names.groupBy("part")).applyInArrow(run, NEXT), **DENSE)


def _described(groups: DataFrame, shorter: DataFrame) -> DataFrame:
    """Groups (id, first, second, f) with language, text, last word, and the counts of their
    leading and trailing words: heads[i] is the count of the first i + 1 words."""
    first = shorter.select(
        F.col("id").alias("first"), "lang", F.col("text").alias("lead"), F.col("f").alias("first_f"), "heads"
    )
    second = shorter.select(F.col("id").alias("second"), "last", F.col("f").alias("second_f"), "tails")
    return staged(
        groups.join(first, "first")
        .join(second, "second")
        .select(
            "id",
            "first",
            "second",
            "lang",
            F.concat_ws(" ", "lead", "last").alias("text"),
            "last",
            "f",
            F.concat("heads", F.array("first_f")).alias("heads"),
            F.concat("tails", F.array("second_f")).alias("tails"),
        )
    )


def _scored(phrases: DataFrame, size: int) -> DataFrame:
    """Best cut of phrases of `size` words: the lowest score, then the smallest k."""

    def cut(k: int):
        left, right = F.get("heads", F.lit(k - 1)), F.get("tails", F.lit(size - k - 1))
        wide = [column.cast("decimal(20,0)") for column in (F.col("f"), left, right)]
        product = wide[0] * F.lit(2000000).cast("decimal(7,0)")
        total = wide[1] + wide[2]
        # Whole numbers: the quotient of what is left after the remainder has no fraction.
        score = ((product - product % total) / total).cast("decimal(38,0)").cast("long")
        return F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))

    lowest = F.least(*[cut(k) for k in range(1, size)]) if size > 2 else cut(1)
    return phrases.withColumn("cut", lowest).select("id", "lang", "text", "f", "cut.score", "cut.l", "cut.r")


def collocations(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    min_count: int = 30,
    max_words: int = 4,
    absorbed_percent: int = 80,
    top: int = 2000,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language."""
    source = narrowed(docs, text=text_column, lang=lang_column)
    source = source.select(F.col("text").cast("binary"), F.col("lang").cast("string"))
    parts = _parts(source)
    states = parts.filter("symbols is not null")
    totals = states.groupBy("lang").agg(F.sum("words").alias("n"))
    buckets = max(LEAST_BUCKETS, (totals.agg(F.sum("n")).first()[0] or 0) // BUCKET_WORDS)
    states = states.withColumn("ids", F.lit(None).cast("binary"))
    found = _frequent_words(parts.filter("code is not null"), min_count)
    names = _names_by_part(found)
    empty = F.array().cast("array<long>")
    text = F.col("word").cast("string")
    described = [
        staged(
            found.filter("name = id").select(
                "id", "lang", text.alias("text"), text.alias("last"), "f", empty.alias("heads"), empty.alias("tails")
            )
        )
    ]
    for size in range(2, max_words + 1):
        last = size == max_words  # nothing is extended any more: no entry needs its group's name
        longer = _extended(states, names, buckets, last)
        states = longer.filter("symbols is not null")
        found = _frequent_pairs(longer.filter("entries is not null"), min_count, groups_only=last)
        names = found.filter("names is not null").select("part", "names")
        groups = found.filter("id is not null").select("id", "first", "second", "f")
        described.append(_described(groups, described[-1]))

    results = None
    for size in range(2, max_words + 1):
        kept = _scored(described[size - 1], size)
        if size < max_words:
            longer = described[size]
            holders = longer.select(F.col("first").alias("held_id"), F.col("f").alias("longer_f")).unionAll(
                longer.select("second", "f")
            )
            most = holders.groupBy("held_id").agg(F.max("longer_f").alias("longer_f"))
            absorbed = 100 * F.coalesce("longer_f", F.lit(0)) >= absorbed_percent * F.col("f")
            kept = kept.join(most, F.col("id") == F.col("held_id"), "left").filter(~absorbed)
        kept = kept.select("lang", F.col("text").alias("phrase"), F.col("f").alias("a"), "l", "r", "score")
        results = kept if results is None else results.unionAll(kept)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        results.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
