"""Near-duplicate vectors by iterative quantisation, multi-index tables and exact reranking.

A binary code is the sign of a rotated, centred vector. The rotation is learned by iterative
quantisation (Procrustes steps between the vectors and their signs) on principal directions of
a bounded sample, so that the bits are balanced and few pairs of neighbours straddle them. A
code is read as several strings of `width` bits, each the key of one table, and vectors that
share a key of any table are compared. Further rotations, learned from other starting points,
give further tables.

`width` follows the number of vectors (about one vector a key); the number of tables follows
from the sample: vectors are turned away from it by exactly the angle of the similarity, in the
direction of other sampled vectors, and tables are added until at most `miss` of these pairs
share no key. Pairs that are more similar are missed more rarely still. A width that would take
more than `most_tables` is lessened, which costs comparisons, not results.

Equal vectors are one class with a weight. Keys of one class are dropped before any vector
moves. A key of many classes is dealt into blocks, and every pair of blocks meets in a task of
its own; no pair is written: a task counts the links of each class and keeps only edges that
connect its classes. A pair that meets in several tables counts in the first. Which tables a
pair shares is computed from the vectors again: projections are sums of whole numbers below
2 ** 53, so a code never depends on the machine or the batch.

Similarities come from the original vectors in double precision, scaled by a power of two first,
so that no square overflows.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component, and
rows without an id, are linked with nothing (no links, themselves as component, kept); vectors
are compared with those of equal length; each row counts as a vector, also where it repeats
another's id; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import arrow_map, narrowed
from sediment.llm.components import components
from sediment.sinks.staging import staged

SAMPLE_ROWS = 4096
STEPS = 20
PAIRS = 4096  # tried for the number of tables, at least
BLOCK = 2048
SHIFTED = 24  # larger groups are compared as a matrix product
AT_ONCE = 16384
FRACTION_BITS = 15  # of a unit vector's components
WEIGHT_BITS = 12  # of a rotation's


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; a power of two is taken out first, so that no square overflows."""
    largest = np.abs(x).max(axis=1, initial=0)
    scaled = np.ldexp(x, -np.frexp(largest)[1][:, None])
    return scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


def rotation(v: np.ndarray, seed: int, steps: int = STEPS) -> np.ndarray:
    """The orthogonal matrix whose signs of v @ R are nearest to v @ R, from a random start."""
    bits = v.shape[1]
    turned = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))[0]
    for _ in range(steps):
        left, _, right = np.linalg.svd(np.where(v @ turned >= 0, 1.0, -1.0).T @ v)
        turned = (left @ right).T
    return turned


@dataclass(frozen=True)
class Codes:
    """`weights` (whole numbers, dimensions x bits) and `middle` give the bits, `tables` strings of `width`."""

    weights: np.ndarray
    middle: np.ndarray
    width: int
    tables: int

    def keys(self, units: np.ndarray) -> np.ndarray:
        """rows x tables: the string of each table as a number."""
        whole = np.rint(np.ldexp(units, FRACTION_BITS))
        bits = (whole @ self.weights) >= self.middle
        strings = bits[:, : self.width * self.tables].reshape(len(units), self.tables, self.width)
        return (strings * (1 << np.arange(self.width, dtype=np.int64))).sum(axis=2)


class Rotations:
    """Bits of as many rotations as asked for, learned one by one."""

    def __init__(self, sample: np.ndarray) -> None:
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        values, directions = np.linalg.eigh(centred.T @ centred)
        spread = values > values.max() * 1e-9
        self.directions = directions[:, spread][:, ::-1] if spread.any() else np.eye(sample.shape[1])
        self.projected = centred @ self.directions
        self.weights = np.zeros((sample.shape[1], 0))
        self.learned = 0

    def codes(self, width: int, tables: int) -> Codes:
        while self.weights.shape[1] < width * tables:
            turned = self.directions @ rotation(self.projected, self.learned)
            self.weights = np.hstack([self.weights, np.rint(np.ldexp(turned, WEIGHT_BITS))])
            self.learned += 1
        middle = np.ldexp(self.mean, FRACTION_BITS) @ self.weights
        return Codes(self.weights, np.rint(middle), width, tables)


def at_angle(units: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs with the given cosine: each vector, and itself turned towards others of the rows."""
    shifts = range(1, min(len(units), 1 + math.ceil(PAIRS / max(1, len(units)))))
    other = np.concatenate([np.roll(units, shift, axis=0) for shift in shifts] or [units])
    units = np.concatenate([units for _ in shifts] or [units])
    across = other - (units * other).sum(axis=1)[:, None] * units
    length = np.sqrt((across * across).sum(axis=1))
    able = length > 1e-9
    turned = cosine * units[able] + math.sqrt(max(0.0, 1 - cosine * cosine)) * across[able] / length[able][:, None]
    return units[able], turned


def learned(sample: np.ndarray, number: int, cosine: float, miss: float, most_tables: int) -> Codes:
    """Codes for `number` vectors like those of the sample (unit rows, in an order of no meaning)."""
    rotations = Rotations(sample)
    one, other = at_angle(sample, cosine)
    width = max(1, min(40, math.ceil(math.log2(max(2, number)))))
    while True:
        met, tables = np.zeros(len(one), bool), 0
        while tables < most_tables:
            before, tables = tables, min(most_tables, tables + 8)
            codes = rotations.codes(width, tables)
            for start in range(0, len(one), 1024):
                piece = slice(start, start + 1024)
                same = codes.keys(one[piece])[:, before:] == codes.keys(other[piece])[:, before:]
                met[piece] |= same.any(axis=1)
            if (~met).sum() <= miss * len(met):
                return codes
        if width == 1:
            return Codes(rotations.weights[:, :1] * 0, np.zeros(1), 1, 1)  # all in one bucket: exact
        width = max(1, width * 3 // 4)


def _matrix(column: pa.Array, number: type = np.float64) -> np.ndarray:
    """Equally long lists as rows of doubles."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(number).reshape(n, -1) if n else np.zeros((0, 0))


def _hashed(usable_rows: DataFrame) -> DataFrame:
    """Each row with 128 bits of its vector."""

    def run(batches):
        for batch in batches:
            vectors = batch.column("v")
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # no -0.0
            ends = np.concatenate(([0], np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False)))).tolist()
            held = [hashlib.blake2b(flat[a:b].tobytes(), digest_size=16).digest() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(held, pa.binary())], [*batch.schema.names, "class"])

    vector = usable_rows.schema["v"].dataType.simpleString()
    return arrow_map(usable_rows, run, f"vec_id long, v {vector}, class binary")


def _sampled(classes: DataFrame, total: int, rows: int) -> np.ndarray:
    """At most `rows` of the vectors, those with the least hashes; about twice as many are sorted."""
    near = F.pmod(F.xxhash64("class"), F.lit(1 << 40)) < int(min(1.0, 2 * (rows + 64) / total) * (1 << 40))
    held = staged(classes.filter(near).orderBy(F.xxhash64("class"), "class").limit(rows).select("class", "v"))
    found = sorted(held.collect(), key=lambda row: hashlib.blake2b(row["class"]).digest())
    return unit_rows(np.array([row["v"] for row in found], np.float64))


def _thin(classes: DataFrame, models: dict[int, Codes]) -> DataFrame:
    """length, code_table, code, node: a row per class and table."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                piece = batch.slice(start, 1024)
                lengths = piece.column("v").value_lengths().to_numpy(zero_copy_only=False)
                for length in np.unique(lengths).tolist():
                    own = piece.filter(pa.array(lengths == length))
                    model = models[length]
                    keys = model.keys(unit_rows(_matrix(own.column("v"))))
                    n = keys.size
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, length, np.int32)),
                            pa.array(np.tile(np.arange(model.tables, dtype=np.int32), len(keys))),
                            pa.array(keys.ravel()),
                            pa.array(np.repeat(own.column("node").to_numpy(), model.tables)),
                        ],
                        ["length", "code_table", "code", "node"],
                    )

    return arrow_map(classes.select("node", "v"), run, "length int, code_table int, code long, node long")


def _least_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index that each of n nodes reaches over the edges."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


def _pairs_in(x: np.ndarray, group: np.ndarray, side: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs inside the groups (consecutive rows) whose cosine is large enough.

    `side` is 0 where all pairs of a group count, else 1 or 2, and pairs need both sides.
    """
    found, least = [], cosine - 1e-9
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((first, [len(group)])))
    for start, size in zip(first[sizes > SHIFTED].tolist(), sizes[sizes > SHIFTED].tolist()):
        own = x[start : start + size]
        a, b = np.nonzero(np.triu(own @ own.T >= least, 1))
        found.append((start + a, start + b))
    small = np.flatnonzero(np.repeat(sizes <= SHIFTED, sizes))
    for step in range(1, SHIFTED):
        a, b = small[:-step], small[step:]
        same = np.flatnonzero(group[a] == group[b])
        if not len(same):
            break
        a, b = a[same], b[same]
        near = (x[a] * x[b]).sum(axis=1) >= least
        found.append((a[near], b[near]))
    a, b = (np.concatenate(own) for own in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    across = (side[a] == 0) | (side[a] != side[b])
    a, b = a[across], b[across]
    exact = np.zeros(len(a), bool)  # one formula decides, whatever the group's size
    for start in range(0, len(a), AT_ONCE):
        piece = slice(start, start + AT_ONCE)
        exact[piece] = (x[a[piece]] * x[b[piece]]).sum(axis=1) >= cosine
    return a[exact], b[exact]


def _linked(dealt: DataFrame, models: dict[int, Codes], cosine: float) -> DataFrame:
    """node, links: vectors linked with each class in this group; or node, other: an edge."""

    def of_groups(rows: pa.Table):
        n = rows.num_rows
        lengths, tables = rows.column("length").to_numpy(), rows.column("code_table").to_numpy()
        keys = [rows.column(name).to_numpy() for name in ("length", "code_table", "code", "low", "high")]
        new = np.ones(n, bool)
        new[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
        group = np.cumsum(new)
        low, high, block = (rows.column(name).to_numpy() for name in ("low", "high", "block"))
        side = np.where(low == high, 0, np.where(block == low, 1, 2))
        nodes, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            x = unit_rows(_matrix(rows.column("v").take(pa.array(at)).combine_chunks()))
            a, b = _pairs_in(x, group[at], side[at], cosine)
            if not len(a):
                continue
            model, table = models[length], tables[at]
            used, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
            codes = np.concatenate([model.keys(x[used[i : i + 1024]]) for i in range(0, len(used), 1024)])
            one, other = inverse[: len(a)], inverse[len(a) :]
            earlier = np.zeros(len(a), bool)
            for start in range(0, len(a), AT_ONCE):
                piece = slice(start, start + AT_ONCE)
                first = (codes[one[piece]] == codes[other[piece]]).argmax(axis=1)
                earlier[piece] = first < table[a[piece]]
            a, b = a[~earlier], b[~earlier]
            if not len(a):
                continue
            names, inverse = np.unique(nodes[at[np.concatenate([a, b])]], return_inverse=True)
            one, other = inverse[: len(a)], inverse[len(a) :]
            links = np.zeros(len(names), np.int64)
            np.add.at(links, one, copies[at[b]])
            np.add.at(links, other, copies[at[a]])
            root = _least_labels(one, other, len(names))
            below = np.flatnonzero(root != np.arange(len(names)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([names, names[below]])),
                    pa.array(np.concatenate([links, np.zeros(len(below), np.int64)])),
                    pa.array([None] * len(names) + names[root[below]].tolist(), pa.int64()),
                ],
                ["node", "links", "other"],
            )

    def run(batches):
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < AT_ONCE:
                continue
            rows = pa.Table.from_batches(held)
            last = rows.slice(count - 1, 1)
            same = np.ones(count, bool)
            for name in ("length", "code_table", "code", "low", "high"):
                same &= rows.column(name).to_numpy() == last.column(name)[0].as_py()
            whole = int(np.flatnonzero(~same)[-1]) + 1 if (~same).any() else 0
            if whole:
                yield from of_groups(rows.slice(0, whole))
            held = rows.slice(whole).to_batches()
            count -= whole
        if count:
            yield from of_groups(pa.Table.from_batches(held))

    return staged(arrow_map(dealt, run, "node long, links long, other long"))


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.9,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    sample_rows: int = SAMPLE_ROWS,
    miss: float = 0.001,
    most_tables: int = 160,
) -> DataFrame:
    """vec_id, n_links, component_id (smallest id reachable by links), kept: a row per row.

    `sample_rows` bounds the vectors that the rotations are learned from; all are indexed.
    """
    whole = narrowed(vectors, vec_id=id_column, v=vector_column).withColumn("vec_id", F.col("vec_id").cast("long"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    able = F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0)
    able = F.coalesce(able, F.lit(False))
    rows = staged(_hashed(whole.filter(able)))
    numbered = rows.groupBy("class").agg(F.min("vec_id").alias("smallest"), F.count(F.lit(1)).alias("copies"), F.any_value("v").alias("v"))
    # Names are given once, when the frame is written.
    classes = staged(numbered.withColumn("node", F.monotonically_increasing_id()))
    sizes = {row[0]: row[1] for row in classes.groupBy(F.size("v")).count().collect()}  # one row per length
    models = {
        length: learned(_sampled(classes.filter(F.size("v") == length), total, sample_rows), total, cosine, miss, most_tables)
        for length, total in sizes.items()
    }
    key = ["length", "code_table", "code"]
    thin = _thin(classes, models).repartition(*key)
    shared = thin.groupBy(*key).agg(F.count("node").alias("members")).filter("members > 1")
    met = staged(thin.join(shared, key).select(*key, "node", "members"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = (
        met.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*key, F.least("block", "partner").alias("low"), F.greatest("block", "partner").alias("high"), "block", "node")
        .join(classes.select("node", "copies", "v"), "node")
    )
    deal = [*key, "low", "high"]
    linked = _linked(dealt.repartition(*deal).sortWithinPartitions(*deal), models, cosine)
    links = linked.filter("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    found = components(linked.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = staged(
        classes.select("node", "smallest", "copies", "class")
        .join(links, "node", "left")
        .join(found, "node", "left")
        .select(
            "class",
            "smallest",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    least = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    results = staged(named.join(least, "component").select("class", "n_links", "component_id"))
    alone = whole.filter(~able).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    together = rows.select("vec_id", "class").join(results, "class").select("vec_id", "n_links", "component_id")
    return together.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
