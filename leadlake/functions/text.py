"""String expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.config import ID_COLUMNS, LEAD_STRINGS


def clean_text(column: Column) -> Column:
    return F.lower(F.trim(column))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def clean_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Trim and lower-case string columns. Ids keep their case: they are keys, so they are trimmed only."""
    chosen = list(columns) if columns is not None else string_columns(df)
    return df.withColumns({
        c: F.trim(F.col(c)) if c in ID_COLUMNS else clean_text(F.col(c)) for c in chosen
    })


def clean_lead_strings(df: DataFrame) -> DataFrame:
    return clean_strings(df, [c for c in LEAD_STRINGS if c in df.columns])


def normalise_names(df: DataFrame) -> DataFrame:
    """Strip and lower-case column names; two names that become equal are refused."""
    names = [c.strip().lower() for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after normalising: {clashes}")
    return df.toDF(*names)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def unknown_to_null(df: DataFrame, sentinel: str = "unknown") -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in string_columns(df)})


def mask_phone(phone: Column) -> Column:
    """First three and last three characters; short or missing numbers show nothing."""
    shown = F.concat(F.substring(phone, 1, 3), F.lit("****"), F.right(phone, F.lit(3)))
    return F.when(F.length(phone) >= 7, shown).otherwise(F.lit("****"))
