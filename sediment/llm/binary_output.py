"""Token ids as packed binary rows: best-fit decreasing with a search tree over free capacities.

Each task packs what it reads, in buffers of `buffer_tokens` tokens, so nothing is shuffled and
memory is bounded; a buffer holds thousands of sequences, and only the last few of them stay
partly empty. A document longer than a sequence is cut without loss: all its pieces are full
but the first, which may be shorter. Within a buffer pieces are placed longest first, each into
the fullest sequence that still has room, found in a segment tree over the capacities.

A row is one sequence: its ids as one row of a matrix with a fixed width (little-endian
unsigned 16-bit, or 32-bit for larger vocabularies, padded with `pad_id`), the cumulative
segment lengths, and position ids that begin again at 0 in every segment. `write_packed` stores
the rows as parquet; the binary columns of a file laid end to end are the matrices.

Defined results: a null or empty text is one segment that holds the end id alone; rows that
share an id are packed each for itself; a null id is carried; an empty table gives an empty
result. Sequence numbers follow the partitions of the input and are the same when a lost task
is run again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sediment.llm.common import arrow_map, as_bytes, byte_lengths, narrowed, slices
from sediment.llm.tokens import piece_bounds, shared_source, tokenizer

SCHEMA = (
    "sequence_id long, n_tokens int, ids binary, position_ids binary, cu_seqlens array<int>, "
    "doc_ids array<long>, starts array<long>"
)


class CapacityTree:
    """Open sequences by free capacity; finds the smallest capacity that suffices."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.held = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _count(self, room: int, change: int) -> None:
        node = self.leaves + room
        while node:
            self.held[node] += change
            node //= 2

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._count(room, 1)

    def take(self, room: int) -> tuple[int, int] | None:
        """Remove a sequence with the least capacity of at least `room`; its capacity and number."""
        node = self.leaves + room
        if not self.held[node]:
            while node > 1 and (node % 2 or not self.held[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.held[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._count(room, -1)
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """The sequence of each piece, and how many sequences there are."""
    tree, sequences = CapacityTree(capacity), 0
    found = np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        room, sequence = tree.take(length) or (capacity, sequences)
        sequences += sequence == sequences
        found[i] = sequence
        if room > length:
            tree.add(room - length, sequence)
    return found, sequences


def matrices(
    doc_ids: list, documents: list[np.ndarray], capacity: int, pad_id: int, width: str, first: int
) -> pa.RecordBatch:
    """Pack documents (their ids) into rows of the result; sequence numbers from `first` on."""
    bounds = [(d, *bound) for d, own in enumerate(documents) for bound in piece_bounds(len(own), capacity)]
    owner, start, length = np.array(bounds, np.int64).reshape(-1, 3).T
    sequence, count = best_fit_decreasing(length, capacity)
    order = np.argsort(sequence, kind="stable")
    ids = np.full((count, capacity), pad_id, width)
    positions = np.zeros((count, capacity), "<u2" if capacity < 1 << 16 else "<u4")
    used = np.zeros(count, np.int64)
    ends: list[list[int]] = [[0] for _ in range(count)]
    held: list[list[int]] = [[] for _ in range(count)]
    for i in order.tolist():
        s, n = sequence[i], length[i]
        at = used[s]
        ids[s, at : at + n] = documents[owner[i]][start[i] : start[i] + n]
        positions[s, at : at + n] = np.arange(n)
        used[s] += n
        ends[s].append(int(used[s]))
        held[s].append(i)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(first, first + count)),
            pa.array(used, pa.int32()),
            pa.array([row.tobytes() for row in ids], pa.binary()),
            pa.array([row.tobytes() for row in positions], pa.binary()),
            pa.array(ends, pa.list_(pa.int32())),
            pa.array([[doc_ids[owner[i]] for i in own] for own in held], pa.list_(pa.int64())),
            pa.array([[int(start[i]) for i in own] for own in held], pa.list_(pa.int64())),
        ],
        [part.split()[0] for part in SCHEMA.split(", ")],
    )


def packed_rows(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = 1024,
    end_id: int = 2,
    pad_id: int = 0,
    wide: bool = False,
    buffer_tokens: int = 2_000_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per packed sequence; `wide` writes ids of 32 instead of 16 bits."""
    source = shared_source(docs.sparkSession, tokenizer_file)
    width = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        doc_ids, documents, held = [], [], 0
        for batch in batches:
            texts, own_ids = batch.column("text"), batch.column("doc_id").to_pylist()
            for start, end in slices(byte_lengths(texts)):
                found = tokenizer(source.value).encode_batch(as_bytes(texts.slice(start, end - start)), end_id)
                if not wide and max(int(own.max()) for own in found) >= 1 << 16:
                    raise ValueError("this vocabulary needs wide=True")
                doc_ids += own_ids[start:end]
                documents += found
                held += sum(map(len, found))
                if held >= buffer_tokens:
                    result = matrices(doc_ids, documents, capacity, pad_id, width, number)
                    number += result.num_rows
                    doc_ids, documents, held = [], [], 0
                    yield result
        if documents:
            yield matrices(doc_ids, documents, capacity, pad_id, width, number)

    return arrow_map(narrowed(docs, doc_id=id_column, text=text_column), run, SCHEMA)


def write_packed(rows: DataFrame, path: str) -> None:
    rows.write.parquet(path)
