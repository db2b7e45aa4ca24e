"""Exact order statistics without a window over raw rows.

Rows are first collapsed to (key, value, counts): a value held by a third of all rows becomes one row.
The collapsed values are cut into ranges, each range is accumulated on its own, and the totals of the
ranges before it are added. The cut points come from an approximate percentile sketch; they only steer
balance, the result is exact for any cut points.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.functions.numeric import bucket_index
from leadlake.session import rank_buckets


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value) with one row per row and column.

    A generator, not ``unpivot``: the kept columns pass through it unchanged, so two uses of the result in
    one plan stay recognisably equal and share their shuffle.
    """
    pairs = [x for c in columns for x in (F.lit(c), F.col(c))]
    return df.select(*keep, F.stack(F.lit(len(columns)), *pairs).alias("feature", "value"))


def melt(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form (keep..., feature, value) of numeric columns; NULL and NaN are left out."""
    typed = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return long_form(typed, columns, keep).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def cut_points(df: DataFrame, columns: Sequence[str], buckets: int | None = None) -> dict[str, list[float]]:
    """At most ``buckets`` ascending cut points per column: one pass, a few numbers to the driver."""
    n = buckets or rank_buckets(df.sparkSession)
    shares = [i / n for i in range(1, n)]
    clean = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns]
    row = df.agg(*[F.percentile_approx(v, shares).alias(f"p{i}") for i, v in enumerate(clean)]).first()
    return {c: sorted(set(row[f"p{i}"] or [])) for i, c in enumerate(columns)}


def range_of(value: Column, cuts: Mapping[str, Sequence[float]], feature: Column | None = None) -> Column:
    """Range number of a value; with ``feature`` the cut points of that feature apply."""
    if feature is None:
        (only,) = cuts.values()
        return bucket_index(value, only)
    chain = None
    for name, points in cuts.items():
        test, number = feature == name, bucket_index(value, points)
        chain = F.when(test, number) if chain is None else chain.when(test, number)
    return chain


def accumulate(
    counts: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Sequence[str], bucket: Column
) -> DataFrame:
    """Adds ``cum_<m>`` (running sum up to and including the row) and ``tot_<m>`` (sum per key).

    ``counts`` has one row per key and ``order`` value; ``bucket`` must not decrease along ``order``.
    """
    # Never NULL: otherwise the join adds a filter to one side only and the grouped counts are made twice.
    cut = counts.withColumn("_range", F.coalesce(bucket, F.lit(0)))
    per_range = cut.groupBy(*keys, "_range").agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*keys)
    offsets = per_range.select(
        *keys, "_range",
        *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(f"_sum_{m}").over(everything).alias(f"tot_{m}") for m in measures],
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = {f"cum_{m}": F.col(f"_before_{m}") + F.sum(m).over(inside) for m in measures}
    return (
        cut.join(offsets, [*keys, "_range"])
        .withColumns(running)
        .drop("_range", *[f"_before_{m}" for m in measures])
    )


def grouped_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, value, n) over the distinct values of numeric columns; rows without a group are left out."""
    long = melt(df, columns, by)
    for b in by:
        # Said outright, so that every use of the counts gets the same filter and shares one shuffle.
        long = long.filter(F.col(b).isNotNull())
    return long.groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def value_ranks(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, value, n, cum_n, tot_n) over the distinct values of numeric columns."""
    bucket = range_of(F.col("value"), cut_points(df, columns), F.col("feature"))
    return accumulate(grouped_values(df, columns, by), [*by, "feature"], ["value"], ["n"], bucket)


def quantiles(df: DataFrame, columns: Sequence[str], shares: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, n, min, max, <name of each share>): exact, linearly interpolated."""
    return quantiles_of(value_ranks(df, columns, by), shares, by)


def quantiles_of(ranks: DataFrame, shares: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """The same from ranks made before."""
    aggregates = [F.first("tot_n").alias("n"), F.min("value").alias("min"), F.max("value").alias("max")]
    for name, share in shares.items():
        place = (F.col("tot_n") - 1) * F.lit(float(share))
        lower, upper = F.floor(place) + 1, F.ceil(place) + 1
        aggregates += [
            F.min(F.when(F.col("cum_n") >= lower, F.col("value"))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("cum_n") >= upper, F.col("value"))).alias(f"_hi_{name}"),
        ]
    picked = ranks.groupBy(*by, "feature").agg(*aggregates)
    names = {}
    for name, share in shares.items():
        place = (F.col("n") - 1) * F.lit(float(share))
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        names[name] = low + (high - low) * (place - F.floor(place))
    return picked.withColumns(names).select(*by, "feature", "n", "min", "max", *shares)


def quantile_values(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float]]:
    """The same quantiles as driver numbers (columns x shares of them), to build expressions from."""
    named = {f"q{i}": s for i, s in enumerate(shares)}
    rows = {r["feature"]: r for r in quantiles(df, columns, named).collect()}
    return {c: [rows[c][q] for q in named] if c in rows else [] for c in columns}


def row_ranks(df: DataFrame, column: str, ties: Sequence[str], part: Column, name: str) -> DataFrame:
    """Adds ``name``: the row's place 1..n in the order of (column, ties...), and ``_rows`` = n.

    ``ties`` must make the order total. ``part`` cuts rows of one value into pieces and must not decrease
    along ``ties``: a value shared by many rows is then ranked piece by piece.
    """
    bucket = range_of(F.col(column).cast("double"), cut_points(df, [column]))
    tagged = df.withColumn("_part", part)
    counts = tagged.groupBy(column, "_part").agg(F.count(F.lit(1)).alias("n"))
    placed = accumulate(counts, [], [column, "_part"], ["n"], bucket).select(
        column, "_part", (F.col("cum_n") - F.col("n")).alias("_before"), F.col("tot_n").alias("_rows"))
    inside = Window.partitionBy(column, "_part").orderBy(*ties)
    ranked = tagged.join(placed, [column, "_part"])
    return ranked.withColumn(name, F.col("_before") + F.row_number().over(inside)).drop("_part", "_before")


def hash_ranks(df: DataFrame, key: str, by: Sequence[str], seed: int, buckets: int | None = None) -> DataFrame:
    """Adds ``hash_rank`` (1..n per ``by`` group, in the order of a hash of the unique ``key``) and ``group_n``.

    The hash is uniform, so equal slices of it hold about equally many rows whatever the group sizes:
    the largest group is ranked by all tasks together.
    """
    n = buckets or 4 * rank_buckets(df.sparkSession)
    digest = F.md5(F.concat_ws("#", F.col(key).cast("string"), F.lit(str(seed))))
    slice_no = F.floor(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") * n / F.lit(4294967296)).cast("int")
    hashed = df.withColumns({"_digest": digest, "_slice": slice_no})
    per_slice = hashed.groupBy(*by, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *by, "_slice",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("group_n"),
    )
    inside = Window.partitionBy(*by, "_slice").orderBy("_digest", key)
    return (
        hashed.join(offsets, [*by, "_slice"])
        .withColumn("hash_rank", F.col("_before") + F.row_number().over(inside))
        .drop("_digest", "_slice", "_before")
    )
