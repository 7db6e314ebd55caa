"""Helpers shared by the operators: Arrow batches of texts, word hashes, hash arithmetic.

Texts cross to Python as UTF-8 bytes. Words are separated by the six ASCII white-space
characters, which is what `bytes.split()` without arguments does.
"""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WHITESPACE = b" \t\n\x0b\x0c\r"
CHUNK_BYTES = 1 << 20
LARGE_CHUNK_BYTES = 4 << 20


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def narrowed(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: others cannot clash with them."""
    return docs.select([F.col(quoted(column)).alias(name) for name, column in columns.items()])


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def byte_lengths(column: pa.Array) -> list[int]:
    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def slices(lengths: Sequence[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of about `limit` bytes, at least one text each."""
    start = held = 0
    for i, length in enumerate(lengths):
        if i > start and held + length > limit:
            yield start, i
            start, held = i, 0
        held += length
    if start < len(lengths):
        yield start, len(lengths)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Spark send this package to the executors, once per application.

    The archive is made on the driver, which serves it; nothing reads it by its path. A
    package that already runs from an archive (spark-submit --py-files) is not sent again.
    """
    package, application = Path(__file__).resolve().parents[1], spark.sparkContext.applicationId
    if application in _SHIPPED or not package.is_dir():
        return
    _SHIPPED.add(application)
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)


def arrow_map(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def map_texts(
    docs: DataFrame,
    column: str,
    per_slice: Callable[[pa.RecordBatch, list[bytes]], Iterable[pa.RecordBatch]],
    schema: str,
    limit: int = CHUNK_BYTES,
) -> DataFrame:
    """Run a function over the rows of a frame, about `limit` bytes of text at a time.

    Only the texts of one slice become Python objects at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices(byte_lengths(batch.column(column)), limit):
                piece = batch.slice(start, end - start)
                yield from per_slice(piece, as_bytes(piece.column(column)))

    return arrow_map(docs, run, schema)


@dataclass
class Words:
    """The words of several texts: number among the distinct words, hash, place in the joined
    buffer, number per text. Equal numbers mean equal bytes."""

    codes: np.ndarray
    distinct: list[bytes]
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    buffer: np.ndarray

    @property
    def texts(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(WHITESPACE)] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def powers(n: int) -> np.ndarray:
    """1, b, b * b, ... modulo 2 ** 64."""
    factors = np.full(max(n, 1), _BASE)
    factors[0] = 1
    return np.cumprod(factors)


def split_words(texts: Sequence[bytes]) -> Words:
    """Words of all texts at once, without a Python object per word."""
    buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = ~_IS_SPACE[buffer]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edges[::2], edges[1::2]
    text_ends = np.cumsum([len(text) + 1 for text in texts]) if texts else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    codes, distinct = coded_ranges(buffer, starts, ends)
    return Words(codes, distinct, hashes_of(distinct)[codes], starts, ends, counts, buffer)


def coded_ranges(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Number of each byte range among the distinct ones, and these; compared byte by byte."""
    lengths = ends - starts
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    held = np.ascontiguousarray(buffer[ranges(starts, lengths)]) if len(starts) else buffer[:0]
    values = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(held)])
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def hashes_of(words: list[bytes]) -> np.ndarray:
    """64-bit XXH3 of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once. Only keys that share a slot of a table are sorted."""
    bits = max(16, int(len(keys)).bit_length() + 3)
    slots = (keys >> np.uint64(64 - bits)).astype(np.int64)
    maybe = np.flatnonzero(np.bincount(slots, minlength=1 << bits)[slots] > 1)
    order = maybe[np.argsort(keys[maybe])]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    result = np.zeros(len(keys), bool)
    result[order[same[1:] | same[:-1]]] = True
    return result


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def grams(hashes: np.ndarray, size: int, multiplier: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every `size` consecutive words (order matters)."""
    total = hashes[: len(hashes) - size + 1].copy()
    for i in range(1, size):
        total = mix(total * np.uint64(multiplier)) + hashes[i : len(hashes) - size + 1 + i]
    return mix(total)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Offset of each group when groups of the given lengths lie one after another."""
    return np.concatenate(([0], np.cumsum(lengths)))[:-1].astype(np.int64)


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each group of consecutive values; an empty group has 0."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(lengths)
    return (total[ends] - total[ends - lengths]).astype(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every group, concatenated."""
    return np.repeat(starts - starts_of(lengths), lengths) + np.arange(int(lengths.sum()))
