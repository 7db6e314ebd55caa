"""What a landing area holds, folder by folder, in a form that two deliveries can be compared by.

Spark names its files afresh and deals rows to them as it likes, so files say nothing about
content. Here a folder is described by the multiset of its lines: their number, their bytes and
a digest that does not depend on their order or on the files they lie in. The digest adds up
the MD5 of every line, in four slices of 32 bits each, so it is an ordinary sum: combined on the
map side, exact, and equal for equal lines whoever wrote them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICES = 4
HEX_DIGITS = 8  # of a slice


def _slice_sum(digest: Column, number: int) -> Column:
    part = F.substring(digest, number * HEX_DIGITS + 1, HEX_DIGITS)
    return F.sum(F.conv(part, 16, 10).cast("decimal(20,0)"))


def multiset_digest(line: Column) -> Column:
    """Aggregate: a text that is equal for equal multisets of lines; NULL lines count as empty."""
    digest = F.md5(F.coalesce(line, F.lit("")).cast("binary"))
    return F.concat_ws("-", *[_slice_sum(digest, number).cast("string") for number in range(SLICES)])


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """folder (its key=value part below `root`, or empty), rows, bytes, digest of landed text files."""
    lines = spark.read.text(root, recursiveFileLookup=True)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/((?:[^/=]+=[^/]*/)*)[^/]*$", 1)
    return (
        lines.select(F.rtrim(folder, F.lit("/")).alias("folder"), "value")
        .groupBy("folder")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.octet_length("value") + 1).alias("bytes"),
            multiset_digest(F.col("value")).alias("digest"),
        )
    )


def manifest_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Folders whose lines were added, removed or changed: folder, change, rows_before, rows_after.

    A folder whose lines landed again, in whatever order or files, has not changed.
    """
    old, new = (
        df.select("folder", F.col("rows").alias(f"rows_{name}"), F.col("bytes").alias(f"bytes_{name}"), F.col("digest").alias(f"digest_{name}"))
        for df, name in ((before, "before"), (after, "after"))
    )
    same = (
        F.col("rows_before").eqNullSafe(F.col("rows_after"))
        & F.col("bytes_before").eqNullSafe(F.col("bytes_after"))
        & F.col("digest_before").eqNullSafe(F.col("digest_after"))
    )
    change = (
        F.when(F.col("rows_before").isNull(), "added").when(F.col("rows_after").isNull(), "removed").otherwise("changed")
    )
    return (
        old.join(new, "folder", "full")
        .filter(~same)
        .select("folder", change.alias("change"), "rows_before", "rows_after")
    )
