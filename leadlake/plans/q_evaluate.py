"""Registered queries: evaluation of scores, tiers, routing, economics."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake.config import TIER_ACTIONS, TIER_LABELS
from leadlake.operators import evaluate as ev
from leadlake.operators import score
from leadlake.plans import fixtures as fx
from leadlake.plans.catalogue import query, tidy

CUT = 0.45
_TIER = ("CASE WHEN score >= 0.7 THEN '{}' WHEN score >= 0.45 THEN '{}' WHEN score >= 0.25 THEN '{}' ELSE '{}' END")

# The plain way: one full look at the scores per threshold.
_CURVE_RAW = """
SELECT i / 100.0::DOUBLE AS threshold, count(*) FILTER (WHERE score >= i / 100.0::DOUBLE) AS calls,
       count(*) FILTER (WHERE score >= i / 100.0::DOUBLE AND label = 1) AS conversions,
       count(*) FILTER (WHERE label = 1) AS pos
FROM scored CROSS JOIN (SELECT unnest(range(5, 96)) AS i) GROUP BY i"""
_CURVE = f"""
SELECT threshold, CASE WHEN calls = 0 THEN 0.0 ELSE conversions::DOUBLE / calls END AS precision,
       CASE WHEN pos = 0 THEN 0.0 ELSE conversions::DOUBLE / pos END AS recall,
       CASE WHEN calls + pos = 0 THEN 0.0 ELSE 2.0 * conversions / (calls + pos) END::DOUBLE AS f1, calls, conversions,
       (conversions * 150.0 - calls * 5.0)::DOUBLE AS net_profit FROM ({_CURVE_RAW})"""
_CURVE_OUT = """threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, calls, conversions,
  net_profit"""


def curve(spark, sf):
    return ev.threshold_curve(fx.scored(spark, sf))


@query("ev_threshold_curve", f"SELECT {_CURVE_OUT} FROM ({_CURVE})", ("scored",))
def ev_threshold_curve(spark, sf):
    return tidy(curve(spark, sf))


@query("ev_best_threshold", f"""
WITH c AS ({_CURVE})
SELECT (SELECT threshold FROM c ORDER BY f1 DESC, threshold LIMIT 1) AS optimal_threshold_f1, round(max(f1), 6) AS max_f1,
       (SELECT threshold FROM c ORDER BY net_profit DESC, threshold LIMIT 1) AS optimal_threshold_profit,
       max(net_profit) AS max_profit, (SELECT threshold FROM c ORDER BY f1 DESC, threshold LIMIT 1) AS optimal_threshold FROM c""",
       ("scored",))
def ev_best_threshold(spark, sf):
    return tidy(ev.best_thresholds(curve(spark, sf)))


@query("curve_sample", f"SELECT {_CURVE_OUT} FROM ({_CURVE}) WHERE CAST(round(threshold * 100) AS INT) % 5 = 0", ("scored",))
def curve_sample(spark, sf):
    return tidy(ev.curve_sample(curve(spark, sf)))


@query("ev_confusion", f"""
SELECT a AS actual, p AS predicted, count(label) AS n, round(count(label) * 100.0::DOUBLE / (SELECT count(*) FROM scored), 6) AS pct
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(a, p)
LEFT JOIN scored s ON s.label = v.a AND (s.score >= {CUT})::INT = v.p GROUP BY a, p""", ("scored",))
def ev_confusion(spark, sf):
    return tidy(ev.confusion(fx.scored(spark, sf), CUT))


_CELLS = f"""SELECT count(*) FILTER (WHERE label = 1 AND score >= {CUT})::DOUBLE AS tp, count(*) FILTER (WHERE label = 0 AND score >= {CUT})::DOUBLE AS fp,
  count(*) FILTER (WHERE label = 1 AND score < {CUT})::DOUBLE AS fn, count(*) FILTER (WHERE label = 0 AND score < {CUT})::DOUBLE AS tn FROM scored"""


@query("ev_prf", f"""
SELECT round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1
FROM ({_CELLS})""", ("scored",))
def ev_prf(spark, sf):
    return tidy(ev.precision_recall_f1(fx.scored(spark, sf), CUT))


_AUC = """(SELECT (sum(r) FILTER (WHERE label = 1) - p * (p + 1) / 2) / (p * (n - p)) AS v FROM (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r,
         sum(label) OVER ()::DOUBLE AS p, count(*) OVER ()::DOUBLE AS n FROM scored) GROUP BY p, n)"""
_AP = """(SELECT sum((tp - prev) / pos * tp / k) AS v FROM (
  SELECT tp, k, pos, coalesce(lag(tp) OVER (ORDER BY score DESC), 0) AS prev FROM (
    SELECT DISTINCT score, sum(label) OVER (ORDER BY score DESC)::DOUBLE AS tp, count(*) OVER (ORDER BY score DESC)::DOUBLE AS k,
           sum(label) OVER ()::DOUBLE AS pos FROM scored)))"""


@query("ev_roc_auc", f"SELECT round(v, 6) AS roc_auc FROM {_AUC}", ("scored",))
def ev_roc_auc(spark, sf):
    return tidy(ev.roc_auc(fx.scored(spark, sf)))


@query("ev_average_precision", f"SELECT round(v, 6) AS average_precision FROM {_AP}", ("scored",))
def ev_average_precision(spark, sf):
    return tidy(ev.average_precision(fx.scored(spark, sf)))


_POINTS = """SELECT DISTINCT score, sum(label) OVER (ORDER BY score DESC)::DOUBLE AS tp, count(*) OVER (ORDER BY score DESC)::DOUBLE AS k,
  sum(label) OVER ()::DOUBLE AS pos, count(*) OVER ()::DOUBLE AS n FROM scored"""


@query("ev_roc_curve", f"""
SELECT round(score, 6) AS threshold, round((k - tp) / (n - pos), 6) AS fpr, round(tp / pos, 6) AS tpr FROM ({_POINTS})""", ("scored",))
def ev_roc_curve(spark, sf):
    return tidy(ev.roc_curve(fx.scored(spark, sf)))


_PR = f"SELECT score AS threshold, tp / k AS precision, tp / pos AS recall, 2 * tp / (k + pos) AS f1 FROM ({_POINTS})"


@query("ev_pr_curve", f"""
SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM ({_PR})""",
       ("scored",))
def ev_pr_curve(spark, sf):
    return tidy(ev.pr_curve(fx.scored(spark, sf)))


@query("ev_best_observed", f"""
SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM ({_PR}) t ORDER BY t.f1 DESC, t.threshold LIMIT 1""", ("scored",))
def ev_best_observed(spark, sf):
    return tidy(ev.best_observed_threshold(ev.pr_curve(fx.scored(spark, sf))))


@query("ev_class_report", f"""
WITH c AS ({_CELLS}), m AS (
  SELECT tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fn + fp) AS f0, tn + fp AS n0,
         tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fn + fp) AS f1, tp + fn AS n1,
         (tp + tn) / (tp + tn + fp + fn) AS acc, tp + tn + fp + fn AS n FROM c)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(s AS BIGINT) AS support FROM (
  SELECT '0' AS class, p0 AS p, r0 AS r, f0 AS f, n0 AS s FROM m UNION ALL SELECT '1', p1, r1, f1, n1 FROM m
  UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM m
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM m
  UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / n, (r0 * n0 + r1 * n1) / n, (f0 * n0 + f1 * n1) / n, n FROM m)""", ("scored",))
def ev_class_report(spark, sf):
    return tidy(ev.classification_report(fx.scored(spark, sf), CUT))


@query("ev_summary", f"""
SELECT round((SELECT v FROM {_AUC}), 6) AS roc_auc, round((SELECT v FROM {_AP}), 6) AS pr_auc,
       round(2 * tp / (2 * tp + fp + fn), 6) AS f1_score, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       {CUT}::DOUBLE AS threshold_used, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp
FROM ({_CELLS})""", ("scored",))
def ev_summary(spark, sf):
    return tidy(ev.evaluate(fx.scored(spark, sf), CUT))


@query("sc_tier", f"SELECT src_key, {_TIER.format(*TIER_LABELS)} AS priority_tier FROM scored", ("scored",))
def sc_tier(spark, sf):
    return fx.scored(spark, sf).select("src_key", score.priority_tier(F.col("score")).alias("priority_tier"))


@query("sc_action", f"SELECT src_key, {_TIER.format(*TIER_ACTIONS)} AS action FROM scored", ("scored",))
def sc_action(spark, sf):
    tier = score.priority_tier(F.col("score"))
    return fx.scored(spark, sf).select("src_key", score.tier_action(tier).alias("action"))


@query("sc_recommended", f"SELECT src_key, CAST(score >= {CUT} AS INTEGER) AS is_recommended_call FROM scored", ("scored",))
def sc_recommended(spark, sf):
    return fx.scored(spark, sf).select("src_key", score.recommended(F.col("score"), CUT).alias("is_recommended_call"))


@query("sc_route_mode", """
SELECT src_key, CASE WHEN duration IS NULL OR duration = 0 THEN 'pre_call' ELSE 'post_call' END AS mode,
       round(coalesce(duration, 0), 6) AS duration FROM leads_raw""", ("leads_raw",))
def sc_route_mode(spark, sf):
    return tidy(score.route_mode(fx.leads_raw(spark, sf)).select("src_key", "mode", "duration"))


@query("sc_expected_profit", """
SELECT src_key, round(score * 150 - 5, 6) AS expected_profit, round(5.0 / 150.0, 6)::DOUBLE AS break_even FROM scored""", ("scored",))
def sc_expected_profit(spark, sf):
    return tidy(fx.scored(spark, sf).select(
        "src_key", score.expected_profit(F.col("score")).alias("expected_profit"), score.break_even().alias("break_even")))
