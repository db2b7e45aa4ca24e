"""Named views and parameterised SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def register_parquet(spark: SparkSession, name: str, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def register_frame(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def run_sql(spark: SparkSession, query: str, args: Sequence | Mapping | None = None) -> DataFrame:
    """SQL with bound parameters: ``?`` with a list, ``:name`` with a mapping. Values never enter the text."""
    if args is None:
        return spark.sql(query)
    return spark.sql(query, args=dict(args) if isinstance(args, Mapping) else list(args))
