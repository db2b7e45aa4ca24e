"""Profiling and exploratory aggregates. Every operator is a fixed number of jobs, whatever the column count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.config import MONTHS
from leadlake.functions.encode import month_number
from leadlake.operators.ranks import grouped_values, long_form, melt, quantile_values, quantiles

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def melt_text(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    typed = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns])
    return long_form(typed, columns, keep)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n, pct) of one column. The total is a scalar sub-query over the grouped counts, whose
    shuffle is reused, so the table is read once and nothing is joined."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") * 100.0 / total.cast("double"))


def month_counts(df: DataFrame, column: str = "month") -> DataFrame:
    """Counts in calendar order instead of frequency order."""
    counts = df.filter(F.col(column).isin(*MONTHS)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("month_no", month_number(F.col(column))).orderBy("month_no")


def describe_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std (n-1), min, exact quartiles, max; per group when ``by`` is given."""
    moments = melt(df, columns, by).groupBy(*by, "feature").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )
    order = quantiles(df, columns, QUARTILES, by)
    return order.join(moments, [*by, "feature"]).select(
        *by, "feature", F.col("n").alias("count"), "mean", "std", "min", *QUARTILES, "max"
    )


def describe_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, most frequent value and its frequency; ties go to the smallest value."""
    counts = melt_text(df, columns).filter(F.col("value").isNotNull())
    counts = counts.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("feature").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def schema_profile(df: DataFrame, target: str, approximate: bool = False) -> DataFrame:
    """dtype, distinct values, missing values, logical type and role of each column.

    Exact distinct counts go through (feature, value) groups; ``approximate`` uses one sketch pass.
    """
    columns = df.columns
    if approximate:
        wide = df.agg(*[F.struct(F.approx_count_distinct(c).alias("distinct_values"),
                                 F.count(F.when(F.col(c).isNull(), 1)).alias("missing")).alias(c) for c in columns])
        facts = wide.unpivot([], columns, "feature", "f").select("feature", "f.*")
    else:
        groups = melt_text(df, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        facts = groups.groupBy("feature").agg(
            F.count("value").alias("distinct_values"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        )
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    dtype = F.element_at(types, F.col("feature"))
    text = dtype == "string"
    logical = F.when(F.col("feature") == target, "Binary") \
        .when(text & (F.col("distinct_values") == 2), "Binary") \
        .when(text, "Categorical").otherwise("Numerical")
    role = F.when(F.col("feature") == target, "Target").otherwise("Feature")
    return facts.select("feature", dtype.alias("dtype"), "distinct_values", "missing",
                        logical.alias("logical_type"), role.alias("role"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("long"))


def count_matching(df: DataFrame, columns: Sequence[str], test) -> DataFrame:
    """(feature, n, pct) of the rows where ``test(column)`` holds: one aggregate over all columns."""
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.when(test(F.col(c)), 1)).alias(c) for c in columns])
    long = wide.unpivot(["_rows"], list(columns), "feature", "n")
    return long.select("feature", "n", F.try_divide(F.col("n") * 100.0, F.col("_rows")).alias("pct"))


def unknown_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return count_matching(df, columns, lambda c: c == "unknown")


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return count_matching(df, columns, lambda c: c.isNull())


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def group_means(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(by).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency table in long form; absent combinations have no row."""
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def crosstab_wide(df: DataFrame, a: str, b: str, values: Sequence[str]) -> DataFrame:
    """Pivoted table for a given value list, zero where a combination is absent."""
    return df.groupBy(a).pivot(b, list(values)).agg(F.count(F.lit(1))).na.fill(0)


def crosstab_pct(df: DataFrame, a: str, b: str) -> DataFrame:
    counts = crosstab(df, a, b)
    totals = counts.groupBy(a).agg(F.sum("n").alias("_total"))
    return counts.join(totals, a).select(a, b, (F.col("n") * 100.0 / F.col("_total")).alias("pct"))


def histogram(df: DataFrame, column: str, bins: int | None = None, width: float | None = None) -> DataFrame:
    """Equal-width bins from minimum to maximum, last bin closed; empty bins keep a row with 0."""
    value = F.col(column).cast("double")
    clean = df.filter(value.isNotNull() & ~F.isnan(value)).select(value.alias("v"))
    ends = clean.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    spark = df.sparkSession
    if ends.lo is None:
        return spark.createDataFrame([], "bin long, lower double, upper double, n long")
    if bins is None:
        bins = max(1, int((ends.hi - ends.lo) // width) + (1 if (ends.hi - ends.lo) % width else 0))
        step = float(width)
    else:
        step = (ends.hi - ends.lo) / bins or 1.0
    number = F.least(F.floor((F.col("v") - F.lit(ends.lo)) / F.lit(step)), F.lit(bins - 1)).cast("long")
    counts = clean.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = spark.range(bins).withColumnRenamed("id", "bin")
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.lit(ends.lo) + F.col("bin") * F.lit(step)).alias("lower"),
        (F.lit(ends.lo) + (F.col("bin") + 1) * F.lit(step)).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR of the box) and outlier count."""
    quart = quantiles(df, columns, QUARTILES, by)
    iqr = F.col("q75") - F.col("q25")
    fences = quart.withColumns({"_low": F.col("q25") - 1.5 * iqr, "_high": F.col("q75") + 1.5 * iqr})
    values = grouped_values(df, columns, by).withColumnRenamed("n", "_n")
    inside = F.col("value").between(F.col("_low"), F.col("_high"))
    return values.join(fences, [*by, "feature"]).groupBy(*by, "feature").agg(
        *[F.first(q).alias(q) for q in QUARTILES],
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outliers"),
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, outliers, pct, lower_bound, upper_bound) by the 1.5 IQR rule, all columns in one aggregate."""
    quart = quantile_values(df, columns, (0.25, 0.75))
    known = [c for c in columns if quart[c]]
    bounds = {c: (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)) for c, (q1, q3) in quart.items() if c in known}

    def outside(c: str):
        value = F.col(c).cast("double")
        return ~F.isnan(value) & ((value < bounds[c][0]) | (value > bounds[c][1]))

    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.when(outside(c), 1)).alias(c) for c in known])
    long = wide.unpivot(["_rows"], known, "feature", "outliers")
    ends = F.create_map(*[x for c in known for x in (F.lit(c), F.struct(F.lit(bounds[c][0]).alias("lo"), F.lit(bounds[c][1]).alias("hi")))])
    bound = F.element_at(ends, F.col("feature"))
    return long.select(
        "feature", "outliers", (F.col("outliers") * 100.0 / F.col("_rows")).alias("pct"),
        bound["lo"].alias("lower_bound"), bound["hi"].alias("upper_bound"),
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Majority/minority ratio and the accuracy of always answering the majority class."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        (F.max("n").cast("double") / F.min("n")).alias("imbalance_ratio"),
        (F.max("n") * 100.0 / F.sum("n")).alias("majority_baseline_pct"),
    )


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def named_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(step, n) for several tables in one job."""
    parts = [df.agg(F.lit(name).alias("step"), F.count(F.lit(1)).alias("n")) for name, df in frames.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
