"""Explicit schemas; nothing is inferred from raw files."""

from __future__ import annotations

from pyspark.sql import types as T

LEADS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("job", T.StringType()),
    T.StructField("marital", T.StringType()),
    T.StructField("education", T.StringType()),
    T.StructField("default", T.StringType()),
    T.StructField("balance", T.DoubleType()),
    T.StructField("housing", T.StringType()),
    T.StructField("loan", T.StringType()),
    T.StructField("contact", T.StringType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("month", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("campaign", T.IntegerType()),
    T.StructField("pdays", T.IntegerType()),
    T.StructField("previous", T.IntegerType()),
    T.StructField("poutcome", T.StringType()),
    T.StructField("y", T.StringType()),
    T.StructField("src_key", T.LongType()),
])

FEEDBACK = T.StructType([
    T.StructField("feedback_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("agent_id", T.StringType()),
    T.StructField("call_duration", T.IntegerType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("product_type", T.StringType()),
    T.StructField("notes", T.StringType()),
    T.StructField("recorded_at", T.TimestampType()),
])


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns as strings: the shape of a raw file before its contract is checked."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
