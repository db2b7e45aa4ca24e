"""Sinks. Every write goes to a folder of files; a table is never read and overwritten in one step."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def append_batch(df: DataFrame, path: str, batch_id: str) -> None:
    """Append-only table, one partition folder per batch. Writing a batch again replaces that batch, whole and only:
    also when it comes again with fewer rows or none."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "snappy").parquet(batch_folder(path, batch_id))


def batch_folder(path: str, batch_id: str) -> str:
    """Folder of one batch, found again as the partition column ``_batch_id``."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
        raise ValueError(f"a batch id is made of letters, digits, dots, dashes and underscores: {batch_id!r}")
    return f"{path.rstrip('/')}/_batch_id={batch_id}"


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; blanks around values are data and stay."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_by_suffix(df: DataFrame, path: str) -> None:
    if path.rstrip("/").lower().endswith(".parquet"):
        overwrite_table(df, path)
    else:
        write_csv(df, path)


def export_query(spark: SparkSession, query: str, path: str, **tables: DataFrame) -> None:
    """Result of a SQL text to ZSTD Parquet; ``{name}`` in the text stands for a frame passed by name."""
    spark.sql(query, **tables).write.mode("overwrite").option("compression", "zstd").parquet(path)
