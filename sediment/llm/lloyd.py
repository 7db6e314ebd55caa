"""Vector codes by product quantisation with exact integer k-means: active-entry Lloyd.

Each vector is cut into parts, and each part position has a codebook, which starts as that part
of the vectors with the smallest ids. A round assigns every part to the nearest entry (squared
distance, ties to the lower index) and replaces each entry by the floored mean of its parts.

Rows carry the entry and the exact distance of each part from round to round. Where the
assigned entry stayed as it was, the stored distance still holds and no entry that stayed can
have become better, so only entries that moved are compared with it; where the assigned entry
moved, all entries are compared again. Ties still go to the lower index, so the codes are those
of a full scan. Sums for the new entries leave a task as one row per entry and part, and the
driver holds only the codebooks. Every round is one pass over the rows, written to the shared
folder; no row is shuffled.

Distances are integers. They are computed as float products where all partial sums stay below
2 ** 53, else as 64-bit integers.

Defined results: vectors that are null, empty or hold a null or non-finite component are
dropped, also those whose length is not a multiple of the number of parts or not the length of
the first vector (smallest id, null ids last; rows that share an id in order of their
components). A row with a null id or a repeated id counts like any other. With fewer rows than
entries the codebooks are shorter; an empty table gives an empty result and empty codebooks.
Null labels are one group. Components so large that a distance could pass 64 bits raise
OverflowError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import arrow_map, narrowed
from sediment.sinks.staging import staged

ROWS_AT_ONCE = 4096
ROW = "vec_id long, label string, v array<int>, codes array<int>, distances array<long>"
SUM = "part int, entry int, members long, total array<long>"
COLUMNS = [field.split()[0] for field in f"{ROW}, {SUM}".split(", ")]


@dataclass(frozen=True)
class Coded:
    """`rows`: vec_id, label, codes (an index per part), error; `codebooks`: entries x width, per part."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
        numbers = [str(x) for book in self.codebooks for x in book.ravel().tolist()]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def nearest(x: np.ndarray, book: np.ndarray, number: type) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (the lowest of equals) and its squared distance."""
    own, other = x.astype(number), book.astype(number)
    products = (own * own).sum(1)[:, None] - 2 * (own @ other.T) + (other * other).sum(1)[None, :]
    index = products.argmin(1)
    return index, products[np.arange(len(x)), index].astype(np.int64)


def reassigned(
    x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray, number: type
) -> tuple[np.ndarray, np.ndarray]:
    """New codes and distances of one part position; code -1 stands for not assigned yet."""
    code, distance = code.copy(), distance.copy()
    stale = (code < 0) | moved[code]
    rescanned, fixed = np.flatnonzero(stale), np.flatnonzero(~stale)
    if len(rescanned):
        code[rescanned], distance[rescanned] = nearest(x[rescanned], book, number)
    active = np.flatnonzero(moved)
    if len(fixed) and len(active):
        best, least = nearest(x[fixed], book[active], number)
        best = active[best]
        better = (least < distance[fixed]) | ((least == distance[fixed]) & (best < code[fixed]))
        code[fixed[better]], distance[fixed[better]] = best[better], least[better]
    return code, distance


def _sums(code: np.ndarray, x: np.ndarray, members: np.ndarray, total: np.ndarray) -> None:
    order = np.argsort(code, kind="stable")
    held, first, number = np.unique(code[order], return_index=True, return_counts=True)
    members[held] += number
    total[held] += np.add.reduceat(x[order], first, axis=0)


def _passed(rows: DataFrame, books: list[np.ndarray], moved: list[np.ndarray], number: type) -> DataFrame:
    """ROW with new codes and distances, then one SUM row per part and entry that the task used."""
    parts, width = len(books), books[0].shape[1]

    def run(batches):
        members = [np.zeros(len(book), np.int64) for book in books]
        totals = [np.zeros(book.shape, np.int64) for book in books]
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                piece = batch.slice(start, ROWS_AT_ONCE)
                n = piece.num_rows
                x = piece.column("v").flatten().to_numpy().reshape(n, parts, width).astype(np.int64)
                codes = piece.column("codes").flatten().to_numpy().reshape(n, parts)
                distances = piece.column("distances").flatten().to_numpy().reshape(n, parts)
                new = [
                    reassigned(x[:, p], books[p], moved[p], codes[:, p], distances[:, p], number) for p in range(parts)
                ]
                for p, (code, _) in enumerate(new):
                    _sums(code, x[:, p], members[p], totals[p])
                code = np.stack([own for own, _ in new], 1).astype(np.int32)
                distance = np.stack([own for _, own in new], 1)
                ends = pa.array(np.arange(0, n * parts + 1, parts), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("vec_id"),
                        piece.column("label"),
                        piece.column("v"),
                        pa.ListArray.from_arrays(ends, code.ravel()),
                        pa.ListArray.from_arrays(ends, distance.ravel()),
                        *[pa.nulls(n, kind) for kind in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))],
                    ],
                    COLUMNS,
                )
        used = [np.flatnonzero(own) for own in members]
        n = sum(map(len, used))
        if n:
            kinds = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()))
            ends = pa.array(np.arange(0, n * width + 1, width), pa.int32())
            flat = np.concatenate([total[own].ravel() for total, own in zip(totals, used, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.nulls(n, kind) for kind in kinds],
                    pa.array(np.repeat(np.arange(parts, dtype=np.int32), [len(own) for own in used])),
                    pa.array(np.concatenate(used).astype(np.int32)),
                    pa.array(np.concatenate([own[at] for own, at in zip(members, used, strict=True)])),
                    pa.ListArray.from_arrays(ends, flat),
                ],
                COLUMNS,
            )

    return staged(arrow_map(rows, run, f"{ROW}, {SUM}"))


def _moved_books(passed: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The floored means; an entry without parts stays. One row per entry reaches the driver."""
    width = books[0].shape[1]
    sums = (
        passed.filter("part is not null")
        .groupBy("part", "entry")
        .agg(F.sum("members"), F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(width)]))
    )
    new = [book.copy() for book in books]
    for part, entry, members, total in sums.collect():
        new[part][entry] = np.array(total, np.int64) // members
    return new


def usable(vectors: DataFrame, parts: int, scale: int, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """vec_id, label (text), v (array of long) of the rows that are kept, of all lengths."""
    rows = narrowed(vectors, vec_id=id_column, label=label_column, raw=vector_column)
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        rows.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("raw").cast("array<double>"))
        .filter((F.size("raw") > 0) & (F.size("raw") % parts == 0) & finite)
        .select("vec_id", "label", F.transform("raw", lambda x: F.floor(x * scale)).alias("v"))
    )


def coded(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> Coded:
    """Codes after `rounds` rounds and a last assignment; components are floor(scale * x)."""
    rows = staged(usable(vectors, parts, scale, id_column, vector_column, label_column))
    order = (F.col("vec_id").isNull(), F.col("vec_id"), F.col("v"))
    largest, first = rows.agg(
        F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))),
        F.min(F.struct(order[0].alias("last"), "vec_id", "v")),
    ).first()
    if first is None:
        empty = rows.select("vec_id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"))
        return Coded(empty, [])
    length = len(first["v"])
    bound = 4 * length * (int(largest) + 1) ** 2
    if bound >= 2**63:
        raise OverflowError("components are too large for 64-bit distances")
    number = np.float64 if bound < 2**53 else np.int64
    same = rows.filter(F.size("v") == length)
    # Written by executors, so that only `entries` rows reach the driver.
    smallest = staged(same.orderBy(*order).limit(entries).select(*order))
    heads = sorted(smallest.collect(), key=lambda row: (row[0], row["vec_id"] or 0, row["v"]))
    heads = np.array([row["v"] for row in heads], np.int64).reshape(len(heads), parts, length // parts)
    books = [heads[:, p] for p in range(parts)]
    unassigned = {
        "v": F.col("v").cast("array<int>"),
        "codes": F.array_repeat(F.lit(-1), parts),
        "distances": F.array_repeat(F.lit(0).cast("long"), parts),
    }
    state, moved = same.withColumns(unassigned), [np.ones(len(book), bool) for book in books]
    for done in range(rounds + 1):
        passed = _passed(state, books, moved, number)
        state = passed.filter("part is null").select("vec_id", "label", "v", "codes", "distances")
        if done < rounds:
            new = _moved_books(passed, books)
            moved = [(own != old).any(axis=1) for own, old in zip(new, books, strict=True)]
            books = new
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda total, x: total + x)
    return Coded(state.select("vec_id", "label", "codes", error.alias("error")), books)


def with_label_errors(rows: DataFrame, labels: Sequence[str] = ("label",)) -> DataFrame:
    """`label_error`: the error summed over the rows of equal labels, nulls together."""
    per_label = rows.groupBy(*[F.col(name).alias(f"of_{name}") for name in labels]).agg(F.sum("error").alias("label_error"))
    condition = F.lit(True)
    for name in labels:
        condition = condition & F.col(name).eqNullSafe(F.col(f"of_{name}"))
    return rows.join(per_label, condition).drop(*[f"of_{name}" for name in labels])
