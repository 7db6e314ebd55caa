"""Best-fit packing by linear grouping: documents into as few fixed-size sequences as it can.

Lengths are whole numbers up to the capacity, so the histogram of lengths, at most `capacity`
rows, holds all that a plan needs, whatever the size of the corpus:

1. large lengths are ordered, cut into groups of equal cardinality and rounded up to the
   largest of their group; small ones are grouped too, by their mean, only to tell which rooms
   are worth leaving for them;
2. the few sizes that result are packed by configurations (which sizes share a sequence):
   the linear program of cutting stock, solved by column generation; a share of each
   configuration's use, rounded down, is carried out;
3. actual documents take the places of the rounded ones: the longest that is left and not longer
   than the size, and in the last place of a sequence the longest that really fits, so that later
   sequences get shorter documents than planned;
4. the documents that are left, large and small, are placed best fit, longest first, into
   the room that is really free, then into new sequences.

Everything in 3 and 4 happens to runs of equal sequences at once. The plan says, for ranges of
ranks of each length, which sequence and offset they get. Spark ranks the pieces of each
length (spread over buckets, so that a length that a third of all pieces share is not ranked
by one task) and joins them with the broadcast plan, whose size is bounded by the capacity.

Defined results: a null or empty text is one piece that holds the end id alone; rows that
share an id are packed each for itself; a null id is carried; an empty table gives an empty
result. A document longer than the capacity is cut into full pieces, of which the first may be
shorter; no token is lost.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.common import map_texts, narrowed
from sediment.llm.tokens import piece_bounds, shared_source, tokenizer
from sediment.sinks.staging import staged

PIECES = "doc_id long, piece int, start long, length long, ids binary"


def tokenized_pieces(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids (binary, little-endian unsigned 32-bit) of every piece."""
    source = shared_source(docs.sparkSession, tokenizer_file)

    def run(batch, texts):
        own, rows, ids = tokenizer(source.value).encode_batch(texts, end_id), [], []
        for i, tokens in enumerate(own):
            held = tokens.tobytes()
            for piece, (start, length) in enumerate(piece_bounds(len(tokens), capacity)):
                rows.append((i, piece, start, length))
                ids.append(held[4 * start : 4 * (start + length)])
        which, piece, start, length = np.array(rows, np.int64).reshape(-1, 4).T
        columns = [
            batch.column(0).take(pa.array(which)),
            pa.array(piece, pa.int32()),
            pa.array(start),
            pa.array(length),
            pa.array(ids, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids"])

    return map_texts(narrowed(docs, doc_id=id_column, text=text_column), "text", run, PIECES)


@dataclass
class Plan:
    """Rows (length, first, last, sequence, offset): ranks first..last-1 of a length are at
    `offset` of the sequences from `sequence` on, one each."""

    capacity: int
    rows: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    free: list[list[tuple[int, int]]] = field(default_factory=list)  # by room: (sequence, count)
    rooms: list[int] = field(default_factory=list)  # the rooms that have sequences, ascending
    configured: int = 0  # large pieces that configurations placed

    def __post_init__(self) -> None:
        self.free = [[] for _ in range(self.capacity + 1)]

    def leave(self, room: int, sequence: int, count: int) -> None:
        if count and room:
            if not self.free[room]:
                insort(self.rooms, room)
            self.free[room].append((sequence, count))

    def place(self, length: int, first: int, count: int) -> None:
        """Best fit of `count` pieces of one length, ranks from `first` on."""
        while count:
            at = bisect_left(self.rooms, length)
            if at < len(self.rooms):
                room = self.rooms[at]
                sequence, held = self.free[room].pop()
                if not self.free[room]:
                    del self.rooms[at]
                taken = min(held, count)
                self.leave(room, sequence + taken, held - taken)
            else:
                room, sequence = self.capacity, self.sequences
                taken = max(1, count // (self.capacity // length))  # sequences that one length fills
                self.sequences += taken
            self.rows.append((length, first, first + taken, sequence, self.capacity - room))
            self.leave(room - length, sequence, taken)
            first, count = first + taken, count - taken


def best_values(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room the largest total value of sizes (with repetition) that fit, and a size of that choice, or -1."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    sizes_up, values_up = sizes[order], values[order]
    limits = np.searchsorted(sizes_up, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if limits[room]:
            totals = best[room - sizes_up[: limits[room]]] + values_up[: limits[room]]
            top = int(totals.argmax())
            if totals[top] > best[room] + 1e-12:
                best[room], choice[room] = totals[top], order[top]
    return best, choice


def configuration(sizes: np.ndarray, choice: np.ndarray, room: int) -> np.ndarray:
    """How often each size is in the choice for a room."""
    counts = np.zeros(len(sizes), np.int64)
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return counts


def configurations(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int, damping: float = 0.8
) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often to use each: a solution of the linear program of cutting stock.

    Column generation with an explicit basis inverse. Sizes are priced by the program's values
    damped towards their share of the capacity, the values at which only full sequences are
    worth their cost, and each round tries the best configuration around every size. After
    `rounds` rounds the solution so far, a valid one, is taken.
    """
    inverse = np.diag(1.0 / (capacity // sizes))
    columns = np.diag(capacity // sizes)
    use = inverse @ demand
    share, damped = sizes / capacity, damping
    for _ in range(rounds):
        prices = np.maximum(damped * share + (1 - damped) * inverse.sum(axis=0), 0)
        best, choice = best_values(sizes, prices, capacity)
        improved = False
        for around in np.argsort(-(prices + best[capacity - sizes])).tolist():
            column = configuration(sizes, choice, capacity - int(sizes[around]))
            column[around] += 1
            if inverse.sum(axis=0) @ column <= 1 + 1e-6:
                continue
            improved = True
            direction = inverse @ column
            ratio = np.where(direction > 1e-9, use / np.where(direction > 1e-9, direction, 1), np.inf)
            leaving = int(ratio.argmin())
            step = ratio[leaving]
            use = np.maximum(use - step * direction, 0)
            use[leaving] = step
            inverse[leaving] /= direction[leaving]
            direction[leaving] = 0
            inverse -= np.outer(direction, inverse[leaving])
            columns[:, leaving] = column
        if improved:
            damped = damping
        elif damped == 0:
            break
        else:
            damped = max(0.0, round(damped - damping / 4, 9))
    return [(columns[:, i].copy(), float(use[i])) for i in np.flatnonzero(use > 1e-9).tolist()]


def grouped(lengths: list[int], counts: dict[int, int], groups: int, by_mean: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and numbers of pieces: lengths, longest first, in groups of equal cardinality.

    The size of a group is its longest length, or its mean. Groups of one size are one.
    """
    sizes: dict[int, int] = {}
    held = np.array([counts[n] for n in lengths], np.int64)
    ends = np.cumsum(held)
    tokens = np.cumsum(held * np.array(lengths, np.int64))
    total = int(held.sum())

    def before(rank: int) -> int:
        """Tokens of the first pieces."""
        i = min(int(np.searchsorted(ends, rank, side="right")), len(lengths) - 1)
        return int(tokens[i]) - (int(ends[i]) - rank) * lengths[i]

    cuts = sorted({g * total // groups for g in range(groups)} | {total}) if total else []
    for begin, end in zip(cuts, cuts[1:]):
        longest = lengths[int(np.searchsorted(ends, begin, side="right"))]
        size = max(1, round((before(end) - before(begin)) / (end - begin))) if by_mean else longest
        sizes[size] = sizes.get(size, 0) + end - begin
    return np.array(list(sizes), np.int64), np.array(list(sizes.values()), np.int64)


class Grouping:
    """Lengths in groups of equal cardinality, and the configurations of their sizes.

    Small groups only say which rooms are worth leaving: small pieces are placed best fit.
    """

    def __init__(self, counts: dict[int, int], capacity: int, groups: int, small_part: float, rounds: int) -> None:
        self.counts, self.capacity = counts, capacity
        descending = sorted((n for n in counts if n < capacity), reverse=True)
        self.large = [n for n in descending if n > small_part * capacity]
        self.small = [n for n in descending if n <= small_part * capacity]
        self.sizes, demand = grouped(self.large, counts, groups, by_mean=False)
        self.small_sizes, small_demand = grouped(self.small, counts, max(1, groups // 2), by_mean=True)
        found = []
        if len(self.sizes):
            sizes = np.concatenate([self.sizes, self.small_sizes])
            found = configurations(sizes, np.concatenate([demand, small_demand]), capacity, rounds)
        # (large sizes of a sequence, longest first; room left for small pieces; use)
        self.configurations = []
        for column, use in found:
            own = np.repeat(self.sizes, column[: len(self.sizes)]).tolist()
            if own:
                reserve = int(column[len(self.sizes) :] @ self.small_sizes)
                self.configurations.append((sorted(own, reverse=True), reserve, use))
        self.configurations.sort(key=lambda held: (held[0], held[1]), reverse=True)

    def plan(self, share: float) -> Plan:
        """Each configuration this share of its use, rounded down; all other pieces best fit.

        With a share of 1, configurations are also used once for what rounding down left over.
        """
        plan = Plan(self.capacity)
        full = self.counts.get(self.capacity, 0)
        if full:
            plan.rows.append((self.capacity, 0, full, 0, 0))
            plan.sequences = full
        left = {n: self.counts[n] for n in self.large}
        whole = [int(share * use + 1e-6) for _, _, use in self.configurations]
        for (sizes, reserve, _), times in zip(self.configurations, whole, strict=True):
            self.substitute(plan, left, sizes, reserve, times)
        if share == 1:
            parts = [use - times for (_, _, use), times in zip(self.configurations, whole, strict=True)]
            for i in np.argsort(-np.array(parts)).tolist():
                if parts[i] > 0.05:
                    self.substitute(plan, left, *self.configurations[i][:2], 1)
        plan.configured = sum(self.counts[n] for n in self.large) - sum(left.values())
        rest = [(n, self.counts[n] - count, count) for n, count in left.items()]
        rest += [(n, 0, self.counts[n]) for n in self.small]
        for length, first, count in sorted(rest, reverse=True):
            plan.place(length, first, count)
        return plan

    def substitute(self, plan: Plan, left: dict[int, int], sizes: list[int], reserve: int, times: int) -> None:
        """New sequences with documents in place of a configuration's sizes, as runs of equal lengths.

        A size takes the longest documents that are left and not longer; the last one of several
        takes the longest that really fit beside the others and the reserve, so that what
        rounding up added is not lost.
        """
        ascending = sorted(n for n, count in left.items() if count)
        while times:
            room, taken = self.capacity, []
            for i, size in enumerate(sizes):
                most = room - reserve if 0 < i == len(sizes) - 1 else size
                at = bisect_right(ascending, most)
                while at and left[ascending[at - 1]] <= taken.count(ascending[at - 1]):
                    at -= 1
                if not at:
                    return  # no such document is left
                taken.append(ascending[at - 1])
                room -= taken[-1]
            number = min(times, *(left[n] // taken.count(n) for n in taken))
            offset = 0
            for length in taken:
                first = self.counts[length] - left[length]
                plan.rows.append((length, first, first + number, plan.sequences, offset))
                left[length] -= number
                offset += length
                if not left[length]:
                    ascending.remove(length)
            plan.leave(room, plan.sequences, number)
            plan.sequences += number
            times -= number


def packing_plan(
    counts: dict[int, int],
    capacity: int,
    groups: tuple[int, ...] = (32, 64),
    small_part: float = 0.25,
    shares: tuple[float, ...] = (1.0, 0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.6, 0.5),
    rounds: int = 120,
) -> Plan:
    """The plan with the fewest sequences for a histogram of lengths from 1 to the capacity.

    Finer groups round less but leave more to rounding down, and best fit needs some pieces to
    choose from; so a few settings are tried, which only costs work on the histogram. Of equal
    plans the one with the largest share of configurations is kept.
    """
    best = None
    for number in groups:
        grouping = Grouping(counts, capacity, number, small_part, rounds)
        for share in shares:
            plan = grouping.plan(share)
            if best is None or (plan.sequences, -plan.configured) < (best.sequences, -best.configured):
                best = plan
    return best


def packed(pieces: DataFrame, capacity: int = 1024, per_bucket: int = 200_000) -> DataFrame:
    """All columns of the pieces (which have doc_id, piece and length), sequence_id and offset.

    The pieces are read three times: stage them first if they are costly to compute.
    """
    spark = pieces.sparkSession
    histogram = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    plan = packing_plan(histogram, capacity)
    buckets = max(64, -(-sum(histogram.values()) // per_bucket))
    keyed = pieces.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    earlier = Window.partitionBy("__length").orderBy("__in").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        keyed.groupBy(F.col("length").alias("__length"), F.col("__bucket").alias("__in"))
        .count()
        .select("__length", "__in", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("__before"))
    )
    own = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece")
    ranked = (
        keyed.withColumn("__own", F.row_number().over(own) - 1)
        .join(before, (F.col("length") == F.col("__length")) & (F.col("__bucket") == F.col("__in")))
        .withColumn("__rank", F.col("__before") + F.col("__own"))
    )
    rows = spark.createDataFrame(plan.rows, "__for long, __first long, __last long, __sequence long, offset long")
    placed = ranked.join(
        F.broadcast(rows),
        (F.col("length") == F.col("__for"))
        & (F.col("__rank") >= F.col("__first"))
        & (F.col("__rank") < F.col("__last")),
    )
    sequence = F.col("__sequence") + F.col("__rank") - F.col("__first")
    return placed.select(*pieces.columns, sequence.alias("sequence_id"), "offset")


def best_fit_packing(
    docs: DataFrame, tokenizer_file: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = True
) -> DataFrame:
    """Every piece with its place; with its ids, or with their CRC-32 only, which moves far less."""
    pieces = tokenized_pieces(docs, tokenizer_file, capacity, end_id)
    if not with_ids:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packed(staged(pieces), capacity)
