"""Evaluation of scores: (label 0/1, score). Each operator groups the scores once; thresholds never cause extra scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.config import Economics
from leadlake.functions.numeric import bucket_index, ratio_or_zero
from leadlake.operators.ranks import accumulate, cut_points, range_of
from leadlake.session import literal_rows

GRID = tuple(i / 100 for i in range(5, 96))


def _rates(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    precision, recall = ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, tp + fn)
    return precision, recall, ratio_or_zero(2 * tp, 2 * tp + fp + fn)


def threshold_curve(
    df: DataFrame, label: str = "label", score: str = "score", grid: Sequence[float] = GRID,
    money: Economics = Economics(),
) -> DataFrame:
    """precision, recall, F1, calls, conversions and net profit at every threshold, from one pass.

    Each score is reduced to how many thresholds it reaches (at most len(grid)+1 groups); the counts at a
    threshold are the sums of the groups at or above it.
    """
    reached = bucket_index(F.col(score), grid)
    groups = df.groupBy(reached.alias("_reached")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(label).alias("_pos")
    )
    steps = [(0, None), *[(i + 1, float(t)) for i, t in enumerate(grid)]]
    base = literal_rows(df.sparkSession, "_reached int, threshold double", steps)
    filled = base.join(groups, "_reached", "left").na.fill(0, ["_n", "_pos"])
    above = Window.orderBy(F.desc("_reached")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    cumulated = filled.select(
        "threshold", F.sum("_n").over(above).alias("calls"), F.sum("_pos").over(above).alias("conversions"),
        F.sum("_pos").over(everything).alias("_all_pos"),
    ).filter(F.col("threshold").isNotNull())
    tp, calls = F.col("conversions"), F.col("calls")
    precision, recall, f1 = _rates(tp, calls - tp, F.col("_all_pos") - tp)
    profit = tp * F.lit(money.deposit_profit) - calls * F.lit(money.call_cost)
    return cumulated.select(
        "threshold", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
        "calls", "conversions", profit.alias("net_profit"),
    )


def best_thresholds(curve: DataFrame, metric: str = "f1") -> DataFrame:
    """Thresholds of the largest F1 and the largest profit, the lowest threshold winning ties."""
    lowest_first = -F.col("threshold")
    row = curve.agg(
        F.max_by("threshold", F.struct("f1", lowest_first)).alias("optimal_threshold_f1"),
        F.max("f1").alias("max_f1"),
        F.max_by("threshold", F.struct("net_profit", lowest_first)).alias("optimal_threshold_profit"),
        F.max("net_profit").alias("max_profit"),
    )
    chosen = "optimal_threshold_profit" if metric == "net_profit" else "optimal_threshold_f1"
    return row.withColumn("optimal_threshold", F.col(chosen))


def curve_sample(curve: DataFrame, every: int = 5, grid: Sequence[float] = GRID) -> DataFrame:
    """Every k-th point of the small threshold table, for a log."""
    kept = [float(t) for t in grid[::every]]
    return curve.filter(F.col("threshold").isin(kept))


def _cells(label: str, score: str, threshold: float) -> dict[str, Column]:
    pos, hit = F.col(label) == 1, F.col(score) >= F.lit(threshold)

    def count(test: Column) -> Column:
        return F.count(F.when(test, 1))

    return {"tn": count(~pos & ~hit), "fp": count(~pos & hit), "fn": count(pos & ~hit), "tp": count(pos & hit)}


def confusion(df: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """(actual, predicted, n, pct) with all four cells, also the empty ones."""
    row = df.agg(*[c.alias(name) for name, c in _cells(label, score, threshold).items()])
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    cells = F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"),
                 (ratio_or_zero(F.col(c), total) * 100.0).alias("pct"))
        for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ])
    return row.select(F.explode(cells).alias("c")).select("c.*")


def precision_recall_f1(df: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    row = df.agg(*[c.alias(name) for name, c in _cells(label, score, threshold).items()])
    precision, recall, f1 = _rates(F.col("tp"), F.col("fp"), F.col("fn"))
    return row.select(precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def classification_report(df: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """precision, recall, F1, support per class with macro and weighted means; accuracy sits in its own row."""
    row = df.agg(*[c.alias(name) for name, c in _cells(label, score, threshold).items()])
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    p0, r0, f0 = _rates(tn, fn, fp)
    p1, r1, f1 = _rates(tp, fp, fn)
    n0, n1 = tn + fp, tp + fn
    total = n0 + n1
    accuracy = ratio_or_zero(tn + tp, total)

    def line(name: str, p: Column, r: Column, f: Column, n: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        n.cast("long").alias("support"))

    def weighted(a: Column, b: Column) -> Column:
        return ratio_or_zero(a * n0 + b * n1, total)

    lines = F.array(
        line("0", p0, r0, f0, n0),
        line("1", p1, r1, f1, n1),
        line("accuracy", accuracy, accuracy, accuracy, total),
        line("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total),
        line("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), total),
    )
    return row.select(F.explode(lines).alias("l")).select("l.*")


def score_steps(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(score, n, pos, cum_n, cum_pos, tot_n, tot_pos) per distinct score, accumulated from the highest down."""
    counts = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos")
    ).withColumn("_down", -F.col("score"))
    cuts = {score: sorted(-c for c in cut_points(df, [score])[score])}
    steps = accumulate(counts, [], ["_down"], ["n", "pos"], range_of(F.col("_down"), cuts))
    return steps.drop("_down")


def _roc_auc_sum() -> Column:
    """Positives times negatives below them, ties counted half; divided by all pairs later."""
    neg = (F.col("n") - F.col("pos")).cast("double")
    neg_below = (F.col("tot_n") - F.col("tot_pos")) - (F.col("cum_n") - F.col("cum_pos"))
    return F.sum(F.col("pos") * (neg_below + neg / 2.0))


def _average_precision() -> Column:
    gain = F.try_divide(F.col("pos").cast("double"), F.col("tot_pos"))
    return F.coalesce(F.sum(gain * F.col("cum_pos") / F.col("cum_n")), F.lit(0.0))


def _areas(steps: DataFrame) -> DataFrame:
    row = steps.agg(
        _roc_auc_sum().alias("_won"), _average_precision().alias("pr_auc"),
        F.max("tot_n").cast("double").alias("_n"), F.max("tot_pos").cast("double").alias("_p"),
    )
    return row.select(F.try_divide(F.col("_won"), F.col("_p") * (F.col("_n") - F.col("_p"))).alias("roc_auc"), "pr_auc")


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return _areas(score_steps(df, label, score)).select("roc_auc")


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return _areas(score_steps(df, label, score)).select(F.col("pr_auc").alias("average_precision"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    s = score_steps(df, label, score)
    negatives = F.col("tot_n") - F.col("tot_pos")
    return s.select(
        F.col("score").alias("threshold"),
        ratio_or_zero(F.col("cum_n") - F.col("cum_pos"), negatives).alias("fpr"),
        ratio_or_zero(F.col("cum_pos"), F.col("tot_pos")).alias("tpr"),
    )


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall, f1) at every distinct score."""
    s = score_steps(df, label, score)
    tp = F.col("cum_pos")
    precision, recall, f1 = _rates(tp, F.col("cum_n") - tp, F.col("tot_pos") - tp)
    return s.select(F.col("score").alias("threshold"), precision.alias("precision"),
                    recall.alias("recall"), f1.alias("f1"))


def best_observed_threshold(curve: DataFrame) -> DataFrame:
    """The observed score with the largest F1; the lowest one on ties."""
    return curve.agg(
        F.max_by("threshold", F.struct("f1", -F.col("threshold"))).alias("threshold"), F.max("f1").alias("f1")
    )


def evaluate(df: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """One row with ROC-AUC, PR-AUC, F1, precision, recall and the four counts.

    The grouped scores carry everything: cells at the threshold are sums of their counts.
    """
    hit = F.col("score") >= F.lit(threshold)
    neg = F.col("n") - F.col("pos")
    row = score_steps(df, label, score).agg(
        _roc_auc_sum().alias("_won"), _average_precision().alias("pr_auc"),
        F.max("tot_n").cast("double").alias("_n"), F.max("tot_pos").cast("double").alias("_p"),
        *[F.coalesce(F.sum(F.when(test, count)), F.lit(0)).alias(name) for name, test, count in (
            ("tn", ~hit, neg), ("fp", hit, neg), ("fn", ~hit, F.col("pos")), ("tp", hit, F.col("pos")))],
    )
    precision, recall, f1 = _rates(F.col("tp"), F.col("fp"), F.col("fn"))
    return row.select(
        F.try_divide(F.col("_won"), F.col("_p") * (F.col("_n") - F.col("_p"))).alias("roc_auc"), "pr_auc",
        f1.alias("f1_score"), precision.alias("precision"), recall.alias("recall"),
        F.lit(float(threshold)).alias("threshold_used"), "tn", "fp", "fn", "tp",
    )
