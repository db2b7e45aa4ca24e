"""Binning and conversion rates."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from leadlake.functions.numeric import bucket_index
from leadlake.operators.ranks import cut_points, quantile_values, range_of, row_ranks
from leadlake.session import rank_buckets


def fixed_bin(column: Column, edges: Sequence[float]) -> Column:
    """Bin number for half-open bins [a, b); NULL below the first and from the last edge on."""
    value = F.when(~F.isnan(column.cast("double")), column.cast("double"))
    finite = [e for e in edges if math.isfinite(e)]
    first = 0 if math.isinf(edges[0]) else 1
    number = bucket_index(value, finite) - first
    last_open = math.isinf(edges[-1])
    valid = (number >= 0) if last_open else (number >= 0) & (number < len(edges) - 1)
    return F.when(valid, number)


def quantile_edges(df: DataFrame, column: str, q: int) -> list[float]:
    """Distinct edges of ``q`` equal-count bins; equal edges are merged."""
    values = quantile_values(df, [column], [i / q for i in range(q + 1)])[column]
    return sorted(set(values))


def quantile_bin(column: Column, edges: Sequence[float]) -> Column:
    """Bin number for (a, b] bins, with the lowest value in the first bin."""
    value = F.when(~F.isnan(column.cast("double")), column.cast("double"))
    return bucket_index(value, edges[1:-1], closed_left=False)


def rank_first_bins(df: DataFrame, column: str, key: str, q: int, name: str = "bin") -> DataFrame:
    """Equal-count bins even with ties: rows are ranked by (value, key), key unique.

    A value shared by many rows is ranked by key ranges, so no task has to sort all its rows. Keys that are not numbers
    are cut by slices of their hash instead; ties are then in the order of (slice, key).
    """
    clean = df.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    if isinstance(df.schema[key].dataType, NumericType):
        part = range_of(F.col(key).cast("double"), cut_points(clean, [key]))
    else:
        part = F.pmod(F.xxhash64(key), F.lit(rank_buckets(df.sparkSession)))
    ranked = row_ranks(clean, column, [key], part, "_rank")
    place = (F.col("_rank") - 1) * F.lit(q)
    steps = F.greatest(F.col("_rows") - 1, F.lit(1))
    number = F.greatest(F.ceil(place / steps) - 1, F.lit(0)).cast("int")
    return ranked.withColumn(name, number).drop("_rank", "_rows")


def conversion_rate(df: DataFrame, by: str, label: str) -> DataFrame:
    """(by, n, conversion_rate in percent), best first."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), (F.avg(F.col(label)) * 100.0).alias("conversion_rate")
    ).orderBy(F.desc("conversion_rate"), by)


def decile_rates(df: DataFrame, columns: Sequence[str], label: str, q: int = 10) -> DataFrame:
    """(feature, bin, n, yes_pct, no_pct) for quantile bins of several numeric columns, grouped at once."""
    quants = quantile_values(df, columns, [i / q for i in range(q + 1)])
    bins = df.select(F.col(label).alias("_label"), *[
        quantile_bin(F.col(c), sorted(set(quants[c]))).alias(c) for c in columns
    ])
    long = bins.unpivot(["_label"], list(columns), "feature", "bin").filter(F.col("bin").isNotNull())
    rates = long.groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("n"), (F.avg("_label") * 100.0).alias("yes_pct")
    )
    return rates.withColumn("no_pct", 100.0 - F.col("yes_pct"))
