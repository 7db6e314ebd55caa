"""Exact top-k inner products by the threshold algorithm, over blocks of vectors and queries.

Vectors are dealt into blocks by hash; a task holds one block and one block of queries. Within
a block every dimension has a list of the vectors in order of that component. A query walks
all its lists in parallel (from the top where its own component is positive, from the bottom
where it is negative), scores every vector it meets for the first time in full, and stops when
even a vector that had the last seen value in every list could not reach the k-th best score.
Equal scores go to the smaller id, so the walk goes on while the bound equals the k-th score.
The best k of each block and query meet in one ranking per query.

Defined results: components are floor(scale * x) with x as double; vectors that are null or
hold a null or non-finite component, and rows without an id, take no part; components so large
that a score could pass 64 bits raise OverflowError; vectors are compared with those of the same
length; rows that repeat id and vector count once; rows that share the
query's id are not its candidates; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.common import quoted, ship
from sediment.sinks.staging import staged

RESULT = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """vec_id and v (array of long) of the rows that take part."""
    usable = F.forall(
        F.col("raw"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return (
        vectors.select(
            F.col(quoted(id_column)).cast("long").alias("vec_id"),
            F.col(quoted(vector_column)).cast("array<double>").alias("raw"),
        )
        .filter(F.col("vec_id").isNotNull() & F.col("raw").isNotNull() & usable)
        .select("vec_id", F.transform("raw", lambda x: F.floor(x * scale)).alias("v"))
    )


class SortedLists:
    """A block of vectors with one list per dimension, from the largest component down."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(-vectors, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(vectors, self.order.T, axis=0).T.copy()

    def best(self, own_id: int, query: np.ndarray, k: int, depth: int = 8) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best vectors whose id is another."""
        dims = np.flatnonzero(query != 0)
        n, weights = len(self.ids), query[dims]
        up = weights > 0
        seen = self.ids == own_id
        kept, scores = np.zeros(0, np.int64), self.vectors[:0, 0] if self.vectors.shape[1] else np.zeros(0)
        start = 0
        while start < n:
            stop = min(n, start + depth) if len(dims) else n
            met = np.zeros(n, bool) if len(dims) else np.ones(n, bool)
            met[self.order[dims[up], start:stop]] = True
            met[self.order[dims[~up], n - stop : n - start]] = True
            new = np.flatnonzero(met & ~seen)
            seen[new] = True
            kept = np.concatenate([kept, new])
            scores = np.concatenate([scores, self.vectors[new] @ query])
            if len(kept) > k:
                top = np.lexsort((self.ids[kept], -scores))[:k]
                kept, scores = kept[top], scores[top]
            if len(kept) == k and len(dims):
                last = np.where(up, self.values[dims, stop - 1], self.values[dims, n - stop])
                if scores.min() > last @ weights:
                    break
            start, depth = stop, 2 * depth
        return self.ids[kept], scores


def _block(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a task's rows, each pair once; exact in double where sums stay below 2 ** 53."""
    ids = table.column("vec_id").to_numpy()
    flat = table.column("v").combine_chunks().flatten().to_numpy()
    vectors = flat.reshape(len(ids), -1) if len(ids) else np.zeros((0, 0), np.int64)
    both = np.unique(np.column_stack([ids, vectors]), axis=0)
    return both[:, 0], both[:, 1:]


def _numbers(vectors: np.ndarray, queries: np.ndarray) -> type:
    largest = max(int(np.abs(vectors.astype(object)).max(initial=0)), int(np.abs(queries.astype(object)).max(initial=0)))
    return np.float64 if largest * largest * max(vectors.shape[1], 1) < 2**53 else object


def top_k(
    vectors: DataFrame,
    query_condition: Column,
    k: int = 10,
    scale: int = 1024,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_rows: int = 2048,
    query_rows: int = 32768,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score. `query_condition` is over the column vec_id."""
    rows = staged(integer_vectors(vectors, id_column, vector_column, scale))
    total, asked, largest, longest = rows.agg(
        F.count(F.lit(1)),
        F.count_if(query_condition),
        F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))),
        F.max(F.size("v")),
    ).first()
    if longest and longest * (int(largest or 0) + 1) ** 2 >= 2**63:
        raise OverflowError("components are too large for 64-bit scores")
    blocks, parts = max(1, -(-total // block_rows)), max(1, -(-asked // query_rows))

    def dealt(own: str, own_number: int, other: str, other_number: int, source: DataFrame) -> DataFrame:
        return source.select(
            "vec_id",
            "v",
            F.size("v").alias("dim"),
            F.pmod(F.xxhash64("vec_id"), F.lit(own_number)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_number - 1).cast("long"))).alias(other),
        )

    keys = ("dim", "block", "part")
    held = dealt("block", blocks, "part", parts, rows).groupBy(*keys)
    queries = dealt("part", parts, "block", blocks, rows.filter(query_condition)).groupBy(*keys)

    def search(block: pa.Table, part: pa.Table) -> pa.Table:
        query_ids, ids, scores = [], [], []
        if block.num_rows and part.num_rows:
            (own_ids, own), (asked_ids, asked_vectors) = _block(block), _block(part)
            number = _numbers(own, asked_vectors)
            lists = SortedLists(own_ids, own.astype(number))
            for query_id, query in zip(asked_ids.tolist(), asked_vectors.astype(number), strict=True):
                found, score = lists.best(query_id, query, k)
                query_ids += [query_id] * len(found)
                ids += found.tolist()
                scores += [int(x) for x in score]
        columns = [pa.array(column, pa.int64()) for column in (query_ids, ids, scores)]
        return pa.Table.from_arrays(columns, ["query_id", "vec_id", "score"])

    ship(vectors.sparkSession)
    found = held.cogroup(queries).applyInArrow(search, RESULT)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
