"""Hypothesis tests, association measures and feature ranking, all from pre-aggregated counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.operators.profile import crosstab, melt_text
from leadlake.operators.ranks import accumulate, cut_points, melt, range_of

ALPHA = 0.05


def _chi_square_tail(x: float, dof: int) -> float:
    """P(X >= x) for a whole number of degrees of freedom: the finite series of the incomplete gamma."""
    if dof <= 0 or x <= 0:
        return 1.0
    half = x / 2.0
    if dof % 2 == 0:
        tail, log_term = math.exp(-half), -half
        for k in range(1, dof // 2):
            log_term += math.log(half) - math.log(k)
            tail += math.exp(log_term)
        return min(1.0, tail)
    tail = math.erfc(math.sqrt(half))
    log_term = math.log(2.0) + 0.5 * math.log(half) - half - 0.5 * math.log(math.pi)
    for k in range(1, (dof + 1) // 2):
        tail += math.exp(log_term)
        log_term += math.log(half) - math.log(k + 0.5)
    return min(1.0, tail)


@F.pandas_udf(T.DoubleType())
def chi_square_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    """Applied to one row per tested feature, never to data rows."""
    return pd.Series([_chi_square_tail(float(a), int(d)) for a, d in zip(x, dof)])


@F.pandas_udf(T.DoubleType())
def two_sided_normal_p(z: pd.Series) -> pd.Series:
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2.0)) if v == v else None)


def verdict(p: Column) -> Column:
    return F.when(p < ALPHA, "significant").otherwise("not significant")


def mann_whitney(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(feature, n_0, n_1, u, z): U of class 0, z with tie correction and continuity correction.

    Mid-ranks come from cumulative counts over the distinct values, so the rows are never sorted.
    """
    long = melt(df.filter(F.col(label).isNotNull()), columns, [label])
    # n is made from a and b, so that the two uses of the counts need the same columns and share one shuffle.
    counts = long.groupBy("feature", "value").agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("a"), F.count(F.when(F.col(label) != 0, 1)).alias("b")
    ).withColumn("n", F.col("a") + F.col("b")).drop("b")
    bucket = range_of(F.col("value"), cut_points(df, columns), F.col("feature"))
    ranked = accumulate(counts, ["feature"], ["value"], ["n"], bucket)
    n = F.col("n").cast("double")
    mid_rank = F.col("cum_n") - n + (n + 1.0) / 2.0
    sums = ranked.groupBy("feature").agg(
        F.sum("a").alias("n_0"), F.sum(F.col("n") - F.col("a")).alias("n_1"),
        F.sum(F.col("a") * mid_rank).alias("_r"), F.sum(n * n * n - n).alias("_ties"),
    )
    n0, n1 = F.col("n_0").cast("double"), F.col("n_1").cast("double")
    total = n0 + n1
    u = F.col("_r") - n0 * (n0 + 1.0) / 2.0
    sigma = F.sqrt(n0 * n1 / 12.0 * (total + 1.0 - F.try_divide(F.col("_ties"), total * (total - 1.0))))
    distance = F.greatest(u, n0 * n1 - u) - n0 * n1 / 2.0 - 0.5
    return sums.filter((n0 > 0) & (n1 > 0)).select(
        "feature", "n_0", "n_1", u.alias("u"), F.try_divide(distance, sigma).alias("z")
    )


def mann_whitney_test(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    tested = mann_whitney(df, columns, label).withColumn("p_value", F.least(F.lit(1.0), F.when(
        F.col("z") < 0, 1.0).otherwise(two_sided_normal_p("z"))))
    return tested.withColumn("verdict", verdict(F.col("p_value")))


def _chi_square_from(counts: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """Statistic, dof, sizes per ``keys`` from cell counts (keys..., a, b, n).

    sum (O-E)^2/E equals N * (sum O^2/(R*C) - 1), so empty cells need no row and no cross product is
    built. In a 2x2 table all four |O-E| are equal, which gives Yates' correction from the same sums.
    """
    rows = counts.groupBy(*keys, a).agg(F.sum("n").alias("_r"))
    cols = counts.groupBy(*keys, b).agg(F.sum("n").alias("_c"))
    sizes = rows.groupBy(*keys).agg(F.sum("_r").alias("n_total"), F.count(F.lit(1)).alias("levels_a"))
    widths = cols.groupBy(*keys).agg(F.count(F.when(F.col("_c") > 0, 1)).alias("levels_b"))
    cells = counts.join(rows, [*keys, a]).join(cols, [*keys, b])
    if keys:
        cells = cells.join(sizes, list(keys)).join(widths, list(keys))
    else:
        one = sizes.select(F.struct("*")).scalar()
        cells = cells.withColumns({
            "n_total": one["n_total"], "levels_a": one["levels_a"], "levels_b": widths.scalar()
        })
    share = F.col("_r").cast("double") * F.col("_c")
    gap = F.abs(F.col("n") - share / F.col("n_total"))
    out = cells.groupBy(*keys, "n_total", "levels_a", "levels_b").agg(
        F.sum(F.col("n").cast("double") * F.col("n") / share).alias("_s"), F.max(gap).alias("_gap")
    )
    raw = F.greatest(F.col("n_total") * (F.col("_s") - 1.0), F.lit(0.0))
    two_by_two = (F.col("levels_a") == 2) & (F.col("levels_b") == 2)
    shrink = F.coalesce(F.try_divide(F.greatest(F.col("_gap") - 0.5, F.lit(0.0)), F.col("_gap")), F.lit(0.0))
    dof = (F.col("levels_a") - 1) * (F.col("levels_b") - 1)
    statistic = F.when(dof == 0, 0.0).when(two_by_two, raw * shrink * shrink).otherwise(raw)
    return out.select(*keys, "n_total", "levels_a", "levels_b", statistic.alias("statistic"), dof.alias("dof"))


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """(statistic, dof, n_total, levels_a, levels_b) of two categorical columns."""
    return _chi_square_from(crosstab(df, a, b), [], a, b)


def chi_square_test(df: DataFrame, a: str, b: str) -> DataFrame:
    tested = chi_square(df, a, b).withColumn("p_value", chi_square_p("statistic", "dof"))
    return tested.withColumn("verdict", verdict(F.col("p_value")))


def _label_cells(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    long = melt_text(df.filter(F.col(label).isNotNull()), columns, [label])
    return long.filter(F.col("value").isNotNull()).groupBy("feature", "value", label).agg(F.count(F.lit(1)).alias("n"))


def rank_chi_square(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Chi-square of every column against the label in one grouped aggregate."""
    return _chi_square_from(_label_cells(df, columns, label), ["feature"], "value", label)


def rank_chi_square_test(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    tested = rank_chi_square(df, columns, label).withColumn("p_value", chi_square_p("statistic", "dof"))
    return tested.withColumn("verdict", verdict(F.col("p_value"))).orderBy(F.desc("statistic"), "feature")


def cramers_v(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Bias-corrected Cramer's V of every column with the label."""
    chi = rank_chi_square(df, columns, label)
    n, r, k = (F.col(c).cast("double") for c in ("n_total", "levels_a", "levels_b"))
    phi2 = F.greatest(F.lit(0.0), F.col("statistic") / n - (k - 1.0) * (r - 1.0) / (n - 1.0))
    r_fixed = r - (r - 1.0) * (r - 1.0) / (n - 1.0)
    k_fixed = k - (k - 1.0) * (k - 1.0) / (n - 1.0)
    strength = F.sqrt(F.try_divide(phi2, F.least(k_fixed - 1.0, r_fixed - 1.0)))
    return chi.select("feature", strength.alias("cramers_v")).orderBy(F.desc("cramers_v"), "feature")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r in long form (a, b, r); pairs with a missing value on either side are left out pair by pair."""
    typed = df.select(*[
        F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns
    ])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]

    def pearson(a: str, b: str) -> Column:
        # With itself a column correlates by 1 as soon as it varies: no moments are kept for that.
        return F.when(F.max(a) > F.min(a), 1.0) if a == b else F.corr(a, b)

    wide = typed.agg(*[pearson(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    entries = F.array(*[
        F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs) for x, y in dict.fromkeys([(a, b), (b, a)])
    ])
    return wide.select(F.explode(entries).alias("e")).select("e.*")


def high_correlations(df: DataFrame, columns: Sequence[str], above: float = 0.7) -> DataFrame:
    matrix = correlation_matrix(df, columns)
    return matrix.filter((F.col("a") != F.col("b")) & (F.abs("r") > above) & (F.abs("r") < 1.0))


def correlation_with_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "feature", "r").orderBy(F.desc("r"), "feature")


def mutual_information(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Plug-in mutual information (nats) of discrete columns with the label, all columns at once."""
    cells = _label_cells(df, columns, label)
    rows = cells.groupBy("feature", "value").agg(F.sum("n").alias("_r"))
    cols = cells.groupBy("feature", label).agg(F.sum("n").alias("_c"))
    totals = cols.groupBy("feature").agg(F.sum("_c").alias("_n"))
    joined = cells.join(rows, ["feature", "value"]).join(cols, ["feature", label]).join(totals, "feature")
    n = F.col("n").cast("double")
    term = n / F.col("_n") * F.log(n * F.col("_n") / (F.col("_r").cast("double") * F.col("_c")))
    return joined.groupBy("feature").agg(F.sum(term).alias("mi")).orderBy(F.desc("mi"), "feature")


def select_by_mi(df: DataFrame, columns: Sequence[str], label: str, above: float = 0.0) -> DataFrame:
    """The ranking with its choice. Plug-in MI is never negative, so ``above`` is usually a small margin."""
    return mutual_information(df, columns, label).withColumn("selected", F.col("mi") > F.lit(above))


def extreme_rows(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """The whole row holding each column's minimum and maximum; ties go to the smallest key."""
    row = F.struct(*df.columns)
    aggregates = []
    for c in columns:
        value = F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        known = F.when(value.isNotNull(), F.struct(value, F.col(key)))
        turned = F.when(value.isNotNull(), F.struct(-value, F.col(key)))
        aggregates += [F.min_by(row, known).alias(f"min_{c}"), F.min_by(row, turned).alias(f"max_{c}")]
    wide = df.agg(*aggregates)
    tagged = F.array(*[
        F.struct(F.lit(f"{kind} {c}").alias("extreme"), F.col(f"{kind}_{c}").alias("row"))
        for c in columns for kind in ("min", "max")
    ])
    return wide.select(F.explode(tagged).alias("e")).select("e.extreme", "e.row.*")


def leakage_report(df: DataFrame, features: Sequence[str], target: str, limit: float = 0.999) -> DataFrame:
    """(feature, is_target, perfect_correlation, leaks) for each model input."""
    numeric = [f for f in features if f != target]
    wide = df.agg(*[F.abs(F.corr(F.col(c).cast("double"), F.col(target).cast("double"))).alias(c) for c in numeric])
    report = wide.unpivot([], numeric, "feature", "r").select(
        "feature", F.lit(False).alias("is_target"), F.coalesce(F.col("r") > limit, F.lit(False)).alias("perfect_correlation")
    )
    if target in features:
        own = df.sparkSession.range(1).select(
            F.lit(target).alias("feature"), F.lit(True).alias("is_target"), F.lit(True).alias("perfect_correlation")
        )
        report = report.unionByName(own)
    return report.withColumn("leaks", F.col("is_target") | F.col("perfect_correlation"))
