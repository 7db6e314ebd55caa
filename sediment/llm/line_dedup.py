"""Line dedup: a line that many documents share stays only in the first of them.

Lines are exploded as 128-bit hashes of their keys (the line without ASCII white space at its
ends, A-Z lower-cased), one row per document and key. A key held by at least `min_documents`
distinct documents is repeated; its lines go from all documents but the one with the smallest
id. The join that tells each document its repeated keys moves hashes only and can be split
by adaptive execution when one line is everywhere; the counts are combined on the map side.

Defined results: a null or empty text is one empty line; keys shorter than `min_chars` code
points are always kept, whatever they repeat; a line repeated within its own document only is
kept; rows that share an id count as one document and each is returned; rows with a null id
are returned unchanged and counted nowhere; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import WHITESPACE, map_texts, quoted
from sediment.sinks.staging import staged


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of the line's key; None if the key is too short to count."""
    key = line.strip(WHITESPACE).lower()  # bytes: only A-Z change
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, id_column: str, text_column: str, min_chars: int) -> DataFrame:
    """doc_id, h1, h2: the distinct keys of every row."""

    def explode(batch, texts):
        ids, digests = [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            own = {line_key(line, min_chars) for line in set(text.split(b"\n"))} - {None}
            digests.extend(own)
            ids.extend([doc_id] * len(own))
        halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["doc_id", "h1", "h2"]
        )

    known = docs.select(F.col(quoted(id_column)).alias("doc_id"), F.col(quoted(text_column)).alias("text"))
    return map_texts(known.filter("doc_id is not null"), "text", explode, "doc_id long, h1 long, h2 long")


def repeated_keys(keys: DataFrame, min_documents: int) -> DataFrame:
    """h1, h2, first_doc of the keys that at least `min_documents` documents hold."""
    if min_documents == 2:  # two different ids: the smallest is not the largest
        enough = F.min("doc_id") < F.max("doc_id")
    else:
        enough = F.countDistinct("doc_id") >= min_documents
    grouped = keys.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"), enough.alias("enough"))
    return grouped.filter("enough").drop("enough")


def line_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: tuple[str, ...] = (),
    min_documents: int = 2,
    min_chars: int = 10,
) -> DataFrame:
    """doc_id, kept_text, n_lines (before), n_dropped, and the columns named by `carry`."""
    keys = staged(line_keys(docs, id_column, text_column, min_chars))
    # Staged, so that both sides of the join are plain shuffles and a hot line can be split.
    repeated = staged(repeated_keys(keys, min_documents))
    found = (
        keys.join(repeated, ["h1", "h2"])
        .filter("doc_id > first_doc")
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("h1", "h2")).alias("drops"))
        .withColumnRenamed("doc_id", "dropped_from")
    )
    source = docs.select(
        F.col(quoted(id_column)).alias("doc_id"),
        F.col(quoted(text_column)).alias("text"),
        F.struct([F.col(quoted(c)) for c in carry] or [F.lit(0).alias("none")]).alias("carried"),
    )
    joined = source.join(found, F.col("doc_id") == F.col("dropped_from"), "left").select(
        "doc_id", "text", "carried", F.col("drops.h1").alias("h1"), F.col("drops.h2").alias("h2")
    )

    def reassemble(batch, texts):
        kept, counts, dropped = [], [], []
        for text, h1, h2 in zip(texts, batch.column("h1").to_pylist(), batch.column("h2").to_pylist(), strict=True):
            lines = text.split(b"\n")
            counts.append(len(lines))
            if h1:
                pairs = np.empty((len(h1), 2), "<i8")
                pairs[:, 0], pairs[:, 1] = h1, h2
                gone = {pair.tobytes() for pair in pairs}
                lines = [line for line in lines if line_key(line, min_chars) not in gone]
            dropped.append(counts[-1] - len(lines))
            kept.append(b"\n".join(lines))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array(counts, pa.int64()),
                pa.array(dropped, pa.int64()),
                batch.column("carried"),
            ],
            ["doc_id", "kept_text", "n_lines", "n_dropped", "carried"],
        )

    carried = joined.schema["carried"].dataType.simpleString()
    schema = f"doc_id long, kept_text string, n_lines long, n_dropped long, carried {carried}"
    result = map_texts(joined, "text", reassemble, schema)
    extra = [F.col(f"carried.{quoted(c)}") for c in carry]
    return result.select("doc_id", "kept_text", "n_lines", "n_dropped", *extra)
