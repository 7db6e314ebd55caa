"""JSON lines read with a stated schema, keeping what the schema has no place for.

A permissive reader turns a value of the wrong type, an unknown field and a broken line into
NULL or nothing. Here they stay beside the row as a map from field name to raw text, so that
nothing that landed is lost and faults can be counted, repaired and loaded again. Everything is
built-in parsing over one pass of the text; two parsers read each line, once with the schema and
once as a map of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sediment.operators.keys import quoted

RESCUED = "rescued"
WHOLE_LINE = "_line"


def with_rescued(lines: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """The schema's columns and `rescued` for text lines that should each hold a JSON object.

    `rescued` holds the raw text of fields that the schema lacks and of fields whose value does
    not fit their type; of a line that is not one JSON object it holds the whole text under
    `_line`, and all columns are NULL. It is NULL for a line without a fault. A field that is
    absent or null is no fault. Blank lines are no rows. Other columns of the frame are kept.
    """
    text = F.col(quoted(column))
    others = [F.col(quoted(name)) for name in lines.columns if name != column]
    parsed = lines.filter(F.trim(F.regexp_replace(text, r"\s", " ")) != "").select(
        *others, text.alias("__line"), F.from_json(text, schema).alias("__typed"), _texts(text).alias("__texts")
    )
    sound = F.col("__texts").isNotNull()
    fits = [F.col(f"__typed.{quoted(field.name)}").isNotNull() for field in schema.fields]
    known = F.array(*[F.lit(field.name) for field in schema.fields])
    misfits = F.array_compact(
        F.array(*[F.when(~fit, F.lit(field.name)) for fit, field in zip(fits, schema.fields, strict=True)])
    )

    def left_over(name: Column, value: Column) -> Column:
        return value.isNotNull() & (~F.array_contains(known, name) | F.array_contains(misfits, name))

    faults = F.when(sound, F.map_filter("__texts", left_over)).otherwise(F.create_map(F.lit(WHOLE_LINE), F.col("__line")))
    return parsed.select(
        *others,
        *[F.when(sound, F.col(f"__typed.{quoted(field.name)}")).alias(field.name) for field in schema.fields],
        F.when(F.size(faults) > 0, faults).alias(RESCUED),
    )


def _texts(line: Column) -> Column:
    """The fields of one JSON object as texts; NULL for any other line.

    The line is read as the only element of an array, so that nothing may follow the object.
    """
    options = {"allowSingleQuotes": "false"}
    held = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<map<string,string>>", options)
    closed = F.rtrim(line, F.lit(" \t\r\n")).endswith("}")
    return F.when(closed & (F.size(held) == 1), F.get(held, F.lit(0)))


def read_rescued(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The JSON lines below `path`, with folder columns and `rescued`."""
    return with_rescued(spark.read.text(path), schema)
