"""Population stability between a baseline and incoming data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.config import DRIFT_FEATURES
from leadlake.functions.numeric import bucket_index, coerce_double
from leadlake.operators.ranks import quantile_values
from leadlake.session import literal_rows

EPSILON = 1e-4
MODERATE, SIGNIFICANT = 0.10, 0.25


def inner_edges(baseline: DataFrame, columns: Sequence[str], buckets: int = 10) -> dict[str, list[float]]:
    """Distinct inner quantiles per column; the outer bins are open. The first and last quantile are replaced
    by infinities, so only equal inner edges merge. A column without numbers has no entry."""
    clean = baseline.select(*[coerce_double(c).alias(c) for c in columns])
    quants = quantile_values(clean, columns, [i / buckets for i in range(1, buckets)])
    return {c: sorted(set(q)) for c, q in quants.items() if q}


def bin_counts(df: DataFrame, edges: dict[str, list[float]], name: str) -> DataFrame:
    binned = df.select(*[bucket_index(coerce_double(c), e).alias(c) for c, e in edges.items()])
    long = binned.unpivot([], list(edges), "feature", "bin").filter(F.col("bin").isNotNull())
    return long.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias(name))


def psi_by_feature(
    baseline: DataFrame, incoming: DataFrame, columns: Sequence[str], buckets: int = 10, epsilon: float = EPSILON,
    edges: dict[str, list[float]] | None = None, expected: DataFrame | None = None,
) -> DataFrame:
    """(feature, psi) for all columns in one grouped aggregate; columns empty on one side have no row.

    ``edges`` and ``expected`` take the place of the baseline when it was profiled before.
    """
    edges = edges if edges is not None else inner_edges(baseline, columns, buckets)
    spark = incoming.sparkSession
    expected = expected if expected is not None else bin_counts(baseline, edges, "e")
    if not edges:
        return spark.createDataFrame([], "feature string, psi double")
    frame = literal_rows(spark, "feature string, bin int", [(c, b) for c, e in edges.items() for b in range(len(e) + 1)])
    # Columns x bins rows: everything below works on this small table.
    both = (
        frame.join(expected, ["feature", "bin"], "left")
        .join(bin_counts(incoming, edges, "a"), ["feature", "bin"], "left")
        .na.fill(0, ["e", "a"])
    )
    sides = both.groupBy("feature").agg(
        F.sum("e").alias("_e"), F.sum("a").alias("_a"), F.collect_list(F.struct("e", "a")).alias("_bins")
    ).filter((F.col("_e") > 0) & (F.col("_a") > 0))

    def clipped(part: Column, whole: str) -> Column:
        return F.greatest(part.cast("double") / F.col(whole), F.lit(epsilon))

    def total(side: str, whole: str) -> Column:
        return F.aggregate("_bins", F.lit(0.0), lambda s, b: s + clipped(b[side], whole))

    sums = sides.withColumns({"_es": total("e", "_e"), "_as": total("a", "_a")})

    def term(s: Column, b: Column) -> Column:
        e, a = clipped(b["e"], "_e") / F.col("_es"), clipped(b["a"], "_a") / F.col("_as")
        return s + (a - e) * F.log(a / e)

    return sums.select("feature", F.round(F.aggregate("_bins", F.lit(0.0), term), 4).alias("psi"))


def drift_report(
    baseline: DataFrame | None, incoming: DataFrame, columns: Sequence[str] = DRIFT_FEATURES, threshold: float = SIGNIFICANT,
    edges: dict[str, list[float]] | None = None, expected: DataFrame | None = None,
) -> DataFrame:
    """PSI, status and flag per feature, with the overall verdict on every row.

    ``features_evaluated`` counts the columns present on both sides, including one that is empty.
    """
    if edges is None and (baseline is None or baseline.isEmpty()):
        raise ValueError("a non-empty baseline is required")
    known = list(edges) if edges is not None else baseline.columns
    common = [c for c in columns if c in known and c in incoming.columns]
    psi = psi_by_feature(baseline, incoming, common, edges=edges, expected=expected)
    status = F.when(F.col("psi") >= threshold, "SIGNIFICANT_DRIFT").when(
        F.col("psi") >= MODERATE, "MODERATE_SHIFT").otherwise("STABLE")
    rated = psi.withColumns({"status": status, "is_drifted": F.col("psi") >= threshold})
    any_drift = F.max("is_drifted").over(Window.partitionBy())  # over the few rated features
    return rated.withColumns({
        "features_evaluated": F.lit(len(common)).cast("long"),
        "psi_threshold": F.lit(float(threshold)),
        "drift_detected": any_drift,
        "retrain_recommended": any_drift,
    })
