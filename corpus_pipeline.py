"""From raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), where docs is what its predecessor kept, with the
columns of `documents` (others are left out), and returns what it keeps in the same columns; the
last returns the pieces of documents with their places in sequences. An empty table gives an empty
result in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm import line_dedup, minhash, packing, pii, quality
from sediment.llm.queries import BYTE_BPE
from sediment.sinks.staging import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
CARRIED = ("lang", "source")


def _documents(rows: DataFrame, text: str) -> DataFrame:
    """The columns of documents, with a new text and its length."""
    return rows.withColumn("text", F.col(text)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the rules and the isolation forests, each judged by its own text.

    A null text fails; repeated rows stay or go together; a null id is judged like any other.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept_rows(docs.select(*COLUMNS), labels)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document holds.

    Null texts become empty; rows with a null id stay as they are; rows that share an id count as
    one document and stay.
    """
    return _documents(line_dedup.line_dedup(docs.select(*COLUMNS), carry=CARRIED), "kept_text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, linked from 0.8 on: the one with the smallest id.

    Of rows that repeat id and text one stays; rows with a null id or without a word all stay.
    """
    return minhash.one_of_each_group(docs.select(*COLUMNS), percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind; null texts become empty."""
    return _documents(pii.personal_data(docs.select(*COLUMNS), carry=CARRIED), "clean_text")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and places: doc_id, piece, start, length, ids, sequence_id, offset.

    Null and empty texts give one piece, the end token; every row has pieces of its own.
    """
    return packing.best_fit_packing(docs.select(*COLUMNS), BYTE_BPE)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

# Forest verdicts, similarity links, the field's spans and packing have no SQL; the tests
# compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
