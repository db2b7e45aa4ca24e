"""Registered queries: streaming jobs over the given tables, run until everything available is processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake.operators import drift, train
from leadlake.operators.score import route_mode
from leadlake.plans import fixtures as fx
from leadlake.plans import lakehouse
from leadlake.plans.catalogue import query, tidy
from leadlake.plans.q_models import _OUTPUT, trained_modes
from leadlake.plans.q_monitor import _psi
from leadlake.session import shared_dir
from leadlake.sources import sinks
from leadlake.streaming import jobs


def _leads_stream(spark, sf):
    return fx.leads_from(fx.table_stream(spark, sf, "orders"), fx.table(spark, sf, "customer"))


def _feedback_stream(spark, sf):
    return fx.feedback_from(fx.table_stream(spark, sf, "events"))


_BAD = """age NOT BETWEEN 18 AND 105 OR duration IS NULL OR duration < 0 OR campaign < 1 OR pdays < -1 OR previous < 0"""


@query("str_ingest", f"""
SELECT CASE WHEN {_BAD} THEN 'quarantine' ELSE 'valid' END AS side, src_key, customer_id, round(balance, 6) AS balance FROM leads_raw""",
       ("leads_raw",))
def str_ingest(spark, sf):
    layers = lakehouse.Layers(shared_dir(spark, "stream-lake"))
    jobs.drain(jobs.ingest(_leads_stream(spark, sf), layers, shared_dir(spark, "checkpoint")))
    sides = [
        lakehouse.read_side(spark, layers.bronze, side).select(F.lit(side).alias("side"), "src_key", "customer_id", "balance")
        for side in (lakehouse.VALID, lakehouse.BAD)
    ]
    return tidy(sides[0].unionByName(sides[1]))


@query("str_feedback_log", """
SELECT feedback_id, customer_id, agent_id, call_duration, outcome, CASE WHEN outcome = 'agreed' THEN 'yes' ELSE 'no' END AS y_label,
       '' AS notes, recorded_at FROM call_feedback
WHERE call_duration >= 0 AND outcome IN ('agreed', 'declined', 'callback', 'unreachable')""", ("call_feedback",))
def str_feedback_log(spark, sf):
    path = shared_dir(spark, "feedback-log")
    jobs.drain(jobs.feedback_log(_feedback_stream(spark, sf), path, shared_dir(spark, "checkpoint")))
    return spark.read.parquet(path).withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))


@query("str_feedback_dedup", "SELECT DISTINCT feedback_id, customer_id, outcome FROM call_feedback", ("call_feedback",))
def str_feedback_dedup(spark, sf):
    """Every event is delivered twice."""
    twice = _feedback_stream(spark, sf).unionByName(_feedback_stream(spark, sf))
    path = shared_dir(spark, "feedback-once")
    jobs.drain(jobs.to_parquet(jobs.drop_repeated(twice), path, shared_dir(spark, "checkpoint")))
    return spark.read.parquet(path).select("feedback_id", "customer_id", "outcome")


@query("str_outcome_counts", """
SELECT date_trunc('day', recorded_at)::TIMESTAMP AS window_start,
       CASE WHEN outcome IN ('agreed', 'declined', 'callback', 'unreachable') THEN outcome ELSE 'declined' END AS outcome, count(*) AS n
FROM call_feedback GROUP BY 1, 2""", ("call_feedback",))
def str_outcome_counts(spark, sf):
    path = shared_dir(spark, "outcome-counts")
    jobs.drain(jobs.keep_counts(jobs.outcome_counts(_feedback_stream(spark, sf)), path, shared_dir(spark, "checkpoint")))
    return jobs.latest_counts(spark, path, "window_start timestamp, outcome string").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


_TIER = """CASE WHEN score >= 0.7 THEN 'Tier 1 (Hot - Priority Dispatch)' WHEN score >= 0.45 THEN 'Tier 2 (Warm - Follow Up)'
  WHEN score >= 0.25 THEN 'Tier 3 (Neutral - Low Priority)' ELSE 'Tier 4 (Cold - Do Not Call)' END"""


@query("str_tier_counts", f"""
SELECT date_trunc('day', event_ts)::TIMESTAMP AS window_start, {_TIER} AS priority_tier,
       CASE WHEN coalesce(duration, 0) = 0 THEN 'pre_call' ELSE 'post_call' END AS mode, count(*) AS n
FROM scored s JOIN leads_raw l ON l.src_key = s.src_key
GROUP BY 1, 2, 3""", ("scored",))
def str_tier_counts(spark, sf):
    leads = _leads_stream(spark, sf)
    points = F.pmod(F.col("src_key") * 104729, F.lit(7001)) + F.when(F.col("y") == "yes", 2500).otherwise(0)
    scored = route_mode(leads).select(
        F.col("event_ts").cast("timestamp").alias("event_ts"), "mode", (points.cast("double") / 10000.0).alias("score"))
    path = shared_dir(spark, "tier-counts")
    jobs.drain(jobs.keep_counts(jobs.tier_counts(scored), path, shared_dir(spark, "checkpoint")))
    return jobs.latest_counts(spark, path, "window_start timestamp, priority_tier string, mode string").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("str_latency_hist", """
SELECT count(*) FILTER (WHERE value / 100 <= 0.01) AS le_0_01, count(*) FILTER (WHERE value / 100 <= 0.05) AS le_0_05,
       count(*) FILTER (WHERE value / 100 <= 0.1) AS le_0_1, count(*) FILTER (WHERE value / 100 <= 0.25) AS le_0_25,
       count(*) FILTER (WHERE value / 100 <= 0.5) AS le_0_5, count(*) FILTER (WHERE value / 100 <= 1.0) AS le_1_0,
       count(*) FILTER (WHERE value / 100 <= 2.5) AS le_2_5, count(*) AS le_inf, round(sum(value / 100), 4) AS total_seconds FROM events""")
def str_latency_hist(spark, sf):
    timed = fx.table_stream(spark, sf, "events").select((F.col("value") / 100).alias("latency"))
    path = shared_dir(spark, "latency")
    jobs.drain(jobs.keep_whole_result(jobs.latency_histogram(timed), path, shared_dir(spark, "checkpoint")))
    return tidy(spark.read.parquet(path), 4)


@query("str_drift", f"""
WITH base AS (SELECT * FROM leads_raw WHERE poutcome = 'unknown'), incoming AS (SELECT * FROM leads_raw),
p AS ({' UNION ALL '.join(_psi(c, c, 'base', 'incoming') for c in ('age', 'balance', 'day', 'campaign'))})
SELECT feature, psi, CASE WHEN psi >= 0.25 THEN 'SIGNIFICANT_DRIFT' WHEN psi >= 0.1 THEN 'MODERATE_SHIFT' ELSE 'STABLE' END AS status,
       CAST(1 AS BIGINT) AS batches, CAST((SELECT max(psi) >= 0.25 FROM p) AS BIGINT) AS alerts FROM p""", ("leads_raw",))
def str_drift(spark, sf):
    base = fx.leads_raw(spark, sf).filter("poutcome = 'unknown'")
    edges = drift.inner_edges(base, drift.DRIFT_FEATURES)
    expected, path = shared_dir(spark, "drift-baseline"), shared_dir(spark, "drift")
    sinks.overwrite_table(drift.bin_counts(base, edges, "e"), expected)
    jobs.drain(jobs.watch_drift(_leads_stream(spark, sf), edges, expected, path, shared_dir(spark, "checkpoint")))
    reports = spark.read.parquet(path)
    alerts = jobs.drift_alerts(reports).select(F.struct("*")).scalar()
    return reports.select("feature", "psi", "status", alerts["batches"].alias("batches"), alerts["alerts"].alias("alerts"))


@query("str_score")
def str_score(spark, sf):
    models = trained_modes(spark, sf, train.LOGISTIC)
    path = shared_dir(spark, "stream-scores")
    jobs.drain(jobs.score(_leads_stream(spark, sf).drop("y"), models, path, shared_dir(spark, "checkpoint")))
    return spark.read.parquet(path).select("mode", *_OUTPUT)


@query("str_feedback_totals", "SELECT customer_id, count(*) AS n FROM call_feedback GROUP BY customer_id", ("call_feedback",))
def str_feedback_totals(spark, sf):
    path = shared_dir(spark, "totals")
    jobs.drain(jobs.keep_totals(_feedback_stream(spark, sf), path, shared_dir(spark, "checkpoint")))
    return jobs.latest_totals(spark, path)
