"""Declared schemas of every table, and their enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("user", T.StringType()),
    ]
)

BRONZE = T.StructType(
    RAW.fields
    + [
        T.StructField("source_file", T.StringType()),
        T.StructField("processing_time", T.TimestampType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("mention", T.StringType()),
        T.StructField("cleaned_text", T.StringType()),
        T.StructField("sentiment", T.StringType()),
    ]
)

GOLD = T.StructType(
    SILVER.fields
    + [
        T.StructField("predicted_sentiment", T.StringType()),
        T.StructField("predicted_score", T.DoubleType()),
        T.StructField("predicted_sentiment_id", T.IntegerType()),
        T.StructField("sentiment_id", T.IntegerType()),
    ]
)

LAYERS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}

#: The application table: one row per mention.
MENTIONS = T.StructType(
    [
        T.StructField("min_timestamp", T.TimestampType()),
        T.StructField("max_timestamp", T.TimestampType()),
        T.StructField("mention", T.StringType()),
        T.StructField("negative", T.LongType()),
        T.StructField("neutral", T.LongType()),
        T.StructField("positive", T.LongType()),
        T.StructField("total", T.LongType()),
    ]
)

#: One row per micro-batch of one query.
PROGRESS = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("processing_time", T.LongType()),
        T.StructField("memory_used", T.LongType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_name", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    ]
)

STREAM_STATUS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("message", T.StringType()),
        T.StructField("data_available", T.BooleanType()),
        T.StructField("trigger_active", T.BooleanType()),
    ]
)


class SchemaMismatch(ValueError):
    """A frame lacks declared columns or holds them with another type."""


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Check ``df`` against ``schema`` and put the declared columns first.

    Columns beyond the declared ones are kept: a table may gain columns, it may
    not lose them or change their type.
    """
    found = {field.name: field.dataType for field in df.schema}
    problems = []
    for field in schema:
        if field.name not in found:
            problems.append(f"missing column {field.name}")
        elif found[field.name] != field.dataType:
            problems.append(
                f"column {field.name} is {found[field.name].simpleString()},"
                f" declared {field.dataType.simpleString()}"
            )
    if problems:
        raise SchemaMismatch("; ".join(problems))
    declared = schema.fieldNames()
    return df.select(*declared, *[c for c in df.columns if c not in declared])
