"""Registered queries: dimension, fact, joins, marts, sorting, set operations, lakehouse runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake.operators import conform, contracts, marts, profile, score
from leadlake.plans import fixtures as fx
from leadlake.plans import incremental, lakehouse
from leadlake.plans.catalogue import query, tidy
from leadlake.session import shared_dir

ORDER = ("event_ts", "src_key")


def bronze(spark, sf):
    return contracts.split(fx.leads_dup(spark, sf), contracts.bronze_rules())[0]


def dim(spark, sf):
    return conform.build_dim_customer(bronze(spark, sf), ORDER)


def fact(spark, sf):
    return conform.build_fact_interaction(bronze(spark, sf), ORDER, carry=ORDER)


def counted(spark, sf):
    """Where customers are counted before a join: the raw leads, which cost no aggregate."""
    return fx.leads_dup(spark, sf).select("customer_id")


def features(spark, sf):
    return marts.feature_table(dim(spark, sf), fact(spark, sf), ("interaction_id", *ORDER), counted(spark, sf))


_DIM = "customer_id, age, job, marital, education, in_default, round(balance, 6) AS balance, housing, loan"
_FACT = "interaction_id, customer_id, contact, day, month, round(duration, 6) AS duration, campaign, pdays, previous, poutcome, y"
_FEATURES = """customer_id, age, job, marital, education, in_default, round(balance, 6) AS balance, housing, loan, contact, day,
  month, round(duration, 6) AS duration, campaign, pdays, previous, poutcome, balance_tier, pdays_group,
  financial_pressure_index, campaign_pressure_ratio, is_previously_contacted, past_success_flag, y"""
_LATEST = f"""SELECT {_FEATURES} FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_ts DESC, src_key DESC) AS rn FROM features) WHERE rn = 1"""


@query("slv_dim_customer", f"SELECT {_DIM} FROM dim", ("dim",))
def slv_dim_customer(spark, sf):
    return tidy(dim(spark, sf))


@query("slv_fact_interaction", f"SELECT {_FACT} FROM fact", ("fact",))
def slv_fact_interaction(spark, sf):
    return tidy(fact(spark, sf).drop(*ORDER))


@query("jn_dim_fact", f"""
SELECT f.interaction_id, f.customer_id, f.month, f.y, d.job, d.age, round(d.balance, 6) AS balance
FROM fact f JOIN dim d ON d.customer_id = f.customer_id""", ("dim", "fact"))
def jn_dim_fact(spark, sf):
    joined = conform.join_dim_fact(dim(spark, sf), fact(spark, sf), counted(spark, sf))
    return tidy(joined.select("interaction_id", "customer_id", "month", "y", "job", "age", "balance"))


@query("jn_feature_lookup", f"""
WITH latest AS ({_LATEST}), ids AS (SELECT DISTINCT customer_id FROM call_feedback)
SELECT i.customer_id, l.job, l.balance_tier, l.pdays_group, l.campaign_pressure_ratio, l.balance, l.month
FROM ids i LEFT JOIN latest l ON l.customer_id = i.customer_id""", ("features", "call_feedback"))
def jn_feature_lookup(spark, sf):
    ids = fx.call_feedback(spark, sf).select("customer_id").distinct()
    found = conform.lookup_features(ids, conform.latest_features(features(spark, sf), ORDER))
    return tidy(found.select("customer_id", "job", "balance_tier", "pdays_group", "campaign_pressure_ratio", "balance", "month"))


@query("jn_feature_missing", """
SELECT DISTINCT customer_id FROM call_feedback WHERE customer_id NOT IN (SELECT customer_id FROM features)""",
       ("features", "call_feedback"))
def jn_feature_missing(spark, sf):
    ids = fx.call_feedback(spark, sf).select("customer_id").distinct()
    return conform.missing_features(ids, features(spark, sf))


@query("jn_feedback_label", """
SELECT f.interaction_id, f.customer_id, f.y,
       coalesce((CASE WHEN l.outcome = 'agreed' THEN 'yes' WHEN l.outcome IS NOT NULL THEN 'no' END), f.y) AS label
FROM fact f LEFT JOIN (
  SELECT customer_id, outcome, row_number() OVER (PARTITION BY customer_id ORDER BY recorded_at DESC, feedback_id DESC) AS rn
  FROM call_feedback) l ON l.customer_id = f.customer_id AND l.rn = 1""", ("fact", "call_feedback"))
def jn_feedback_label(spark, sf):
    merged = conform.merge_feedback_labels(fact(spark, sf), fx.call_feedback(spark, sf), counted(spark, sf))
    return merged.select("interaction_id", "customer_id", "y", "label")


_CAMPAIGN = """
SELECT month, contact, CASE WHEN campaign = 1 THEN '1 call' WHEN campaign < 4 THEN '2-3 calls' ELSE '4+ calls' END
         AS campaign_pressure_bucket, count(*) AS total_calls, round(avg(duration), 1) AS avg_duration_seconds,
       CAST(count(*) FILTER (WHERE y = 'yes') AS BIGINT) AS total_conversions,
       round(count(*) FILTER (WHERE y = 'yes') / CAST(count(*) AS DOUBLE), 4) AS conversion_rate
FROM fact GROUP BY ALL"""
_SEGMENT = """
SELECT job, education, housing, loan, count(*) AS total_customers, round(avg(balance), 2) AS avg_balance_eur,
       CAST(count(*) FILTER (WHERE y = 'yes') AS BIGINT) AS total_conversions,
       round(count(*) FILTER (WHERE y = 'yes') / CAST(count(*) AS DOUBLE), 4) AS conversion_rate
FROM fact f JOIN dim d ON d.customer_id = f.customer_id GROUP BY ALL"""


@query("mart_campaign_performance", _CAMPAIGN, ("fact",))
def mart_campaign_performance(spark, sf):
    return marts.campaign_performance(fact(spark, sf))


@query("mart_segment_conversion", _SEGMENT, ("dim", "fact"))
def mart_segment_conversion(spark, sf):
    return marts.segment_conversion(dim(spark, sf), fact(spark, sf))


@query("feature_table", f"SELECT {_FEATURES} FROM features", ("features",))
def feature_table(spark, sf):
    return tidy(features(spark, sf).drop("interaction_id", *ORDER))


@query("agg_row_counts", """
SELECT 'raw' AS step, count(*) AS n FROM leads_dup UNION ALL SELECT 'bronze', count(*) FROM bronze
UNION ALL SELECT 'dim_customer', count(*) FROM dim UNION ALL SELECT 'fact_interaction', count(*) FROM fact""", ("dim", "fact"))
def agg_row_counts(spark, sf):
    return profile.named_counts({
        "raw": fx.leads_dup(spark, sf), "bronze": bronze(spark, sf), "dim_customer": dim(spark, sf),
        "fact_interaction": fact(spark, sf)})


@query("sort_mart", f"SELECT * FROM ({_CAMPAIGN}) ORDER BY total_conversions DESC, month, contact, campaign_pressure_bucket",
       ("fact",))
def sort_mart(spark, sf):
    mart = marts.campaign_performance(fact(spark, sf))
    return marts.sort_mart(mart, "total_conversions", ["month", "contact", "campaign_pressure_bucket"])


@query("topn", """
SELECT src_key, customer_id, round(score, 6) AS score FROM scored ORDER BY scored.score DESC, src_key LIMIT 10""", ("scored",))
def topn(spark, sf):
    return tidy(score.top_n(fx.scored(spark, sf), "score", "src_key", 10).select("src_key", "customer_id", "score"))


@query("sort_dialer_queue", """
SELECT src_key, customer_id, round(score, 6) AS score FROM scored ORDER BY scored.score DESC, src_key""", ("scored",))
def sort_dialer_queue(spark, sf):
    return tidy(score.dialer_queue(fx.scored(spark, sf), "score", "src_key").select("src_key", "customer_id", "score"))


@query("head_tail", """
SELECT * FROM (SELECT 'head' AS part, src_key, job, y FROM leads_raw ORDER BY src_key LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'tail' AS part, src_key, job, y FROM leads_raw ORDER BY src_key DESC LIMIT 5)""", ("leads_raw",))
def head_tail(spark, sf):
    df = fx.leads_raw(spark, sf).select("src_key", "job", "y")
    first = score.head(df, "src_key", 5).select(F.lit("head").alias("part"), "*")
    return first.unionByName(score.tail(df, "src_key", 5).select(F.lit("tail").alias("part"), "*"))


@query("sample_n", "SELECT src_key, customer_id, job, y FROM leads_raw ORDER BY md5(concat(src_key, '#42')), src_key LIMIT 5", ("leads_raw",))
def sample_n(spark, sf):
    return score.sample_rows(fx.leads_raw(spark, sf), "src_key", 5, 42).select("src_key", "customer_id", "job", "y")


@query("union_rows", """
SELECT src_key, y, CAST(NULL AS VARCHAR) AS batch FROM leads_raw UNION ALL SELECT src_key, NULL, 'second' FROM leads_dup""",
       ("leads_dup",))
def union_rows(spark, sf):
    first = fx.leads_raw(spark, sf).select("src_key", "y")
    second = fx.leads_dup(spark, sf).select("src_key", F.lit("second").alias("batch"))
    return first.unionByName(second, allowMissingColumns=True)


@query("pipe_silver", """
SELECT 'dim' AS side, customer_id AS id, job AS text, round(balance, 6) AS amount FROM dim
UNION ALL SELECT 'fact', interaction_id, y, round(duration, 6) FROM fact""", ("dim", "fact"))
def pipe_silver(spark, sf):
    layers = lakehouse.Layers(shared_dir(spark, "silver"))
    lakehouse.ingest_frame(fx.leads_dup(spark, sf), layers, "batch-1")
    lakehouse.build_silver(spark, layers, ORDER)
    d = lakehouse.read_side(spark, layers.dim)
    f = lakehouse.read_side(spark, layers.fact)
    return tidy(
        d.select(F.lit("dim").alias("side"), F.col("customer_id").alias("id"), F.col("job").alias("text"),
                 F.col("balance").alias("amount"))
        .unionByName(f.select(F.lit("fact").alias("side"), F.col("interaction_id").alias("id"), F.col("y").alias("text"),
                              F.col("duration").alias("amount"))))


def _days(spark, sf):
    """All deliveries as two batches."""
    leads = fx.leads_dup(spark, sf)
    late = F.year("event_ts") >= 1996
    return (("day-1", leads.filter(~late)), ("day-2", leads.filter(late)))


_LAKES = {}


def daily_lake(spark, sf):
    """A lake built by one run a batch, made once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LAKES:
        lake = incremental.Lake(shared_dir(spark, "daily-lake"), buckets=16, order=ORDER)
        for name, batch in _days(spark, sf):
            incremental.run_batch(batch, lake, name)
        _LAKES[key] = lake
    return _LAKES[key]


@query("pipe_incremental", f"""
SELECT 'dim' AS side, customer_id AS id, job AS text, round(balance, 6) AS amount FROM dim
UNION ALL SELECT 'fact', interaction_id, y, round(duration, 6) FROM fact
UNION ALL SELECT 'feature', interaction_id, balance_tier, round(campaign_pressure_ratio, 6) FROM features""", ("features",))
def pipe_incremental(spark, sf):
    lake = daily_lake(spark, sf)
    parts = [incremental.table(spark, lake, name).select(
        F.lit(side).alias("side"), F.col(key).alias("id"), F.col(text).alias("text"), F.col(amount).alias("amount"))
        for side, name, key, text, amount in (
            ("dim", incremental.DIM, "customer_id", "job", "balance"), ("fact", incremental.FACT, "interaction_id", "y", "duration"),
            ("feature", incremental.FEATURES, "interaction_id", "balance_tier", "campaign_pressure_ratio"))]
    return tidy(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("pipe_incremental_campaigns", _CAMPAIGN, ("fact",))
def pipe_incremental_campaigns(spark, sf):
    return incremental.table(spark, daily_lake(spark, sf), incremental.CAMPAIGN_MART)


@query("pipe_incremental_segments", _SEGMENT, ("dim", "fact"))
def pipe_incremental_segments(spark, sf):
    return incremental.table(spark, daily_lake(spark, sf), incremental.SEGMENT_MART)


@query("pipe_lakehouse", f"""
SELECT 'bronze' AS step, count(*) AS n FROM bronze
UNION ALL SELECT 'quarantine', (SELECT count(*) FROM leads_dup) - (SELECT count(*) FROM bronze)
UNION ALL SELECT 'dim_customer', count(*) FROM dim
UNION ALL SELECT 'fact_campaign_interaction', count(*) FROM fact
UNION ALL SELECT 'mart_campaign_performance', count(*) FROM ({_CAMPAIGN})
UNION ALL SELECT 'mart_customer_segment_conversion', count(*) FROM ({_SEGMENT})
UNION ALL SELECT 'feature_table', count(*) FROM features""", ("features",))
def pipe_lakehouse(spark, sf):
    layers = lakehouse.Layers(shared_dir(spark, "lake"))
    return lakehouse.run_lakehouse(fx.leads_dup(spark, sf), layers, "batch-1", ORDER)
