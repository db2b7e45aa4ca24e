"""Registered queries: data contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake.functions.features import fill_lead_defaults
from leadlake.functions.hashing import surrogate_id
from leadlake.functions.text import clean_strings
from leadlake.config import INTERACTION_KEY
from leadlake.operators import contracts
from leadlake.plans import fixtures as fx
from leadlake.plans.catalogue import query, tidy

_BAD = {
    "age_range": "age IS NULL OR age NOT BETWEEN 18 AND 105",
    "balance_number": "balance IS NULL",
    "duration_range": "duration IS NULL OR duration < 0",
    "campaign_range": "campaign IS NULL OR campaign < 1",
    "pdays_range": "pdays IS NULL OR pdays < -1",
    "previous_range": "previous IS NULL OR previous < 0",
}
_ANY_BAD = " OR ".join(f"({t})" for t in _BAD.values())
_CLEAN_ALL = """
leads_clean AS (
SELECT trim(customer_id) AS customer_id, age, lower(trim(job)) AS job, lower(trim(marital)) AS marital,
       lower(trim(education)) AS education, lower(trim(in_default)) AS in_default, balance, lower(trim(housing)) AS housing,
       lower(trim(loan)) AS loan, lower(trim(contact)) AS contact, day, lower(trim(month)) AS month, duration, campaign,
       pdays, previous, lower(trim(poutcome)) AS poutcome FROM leads_dup)"""
_JOBS = ("'admin.','blue-collar','entrepreneur','housemaid','management','retired','self-employed','services',"
         "'student','technician','unemployed','unknown'")
_MONTHS = "'jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'"


def _counts(tests: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, CAST(count(*) FILTER (WHERE {test}) AS BIGINT) AS violations FROM {source}"
        for rule, test in tests.items())


@query("ctr_split_valid", f"""
SELECT src_key, customer_id, age, round(duration, 6) AS duration, campaign FROM leads_raw WHERE NOT ({_ANY_BAD})""",
       ("leads_raw",))
def ctr_split_valid(spark, sf):
    valid, _ = contracts.split(fx.leads_raw(spark, sf), contracts.bronze_rules())
    return tidy(valid.select("src_key", "customer_id", "age", "duration", "campaign"))


@query("ctr_split_quarantine", f"""
SELECT src_key, customer_id, age, round(duration, 6) AS duration, campaign FROM leads_raw WHERE {_ANY_BAD}""",
       ("leads_raw",))
def ctr_split_quarantine(spark, sf):
    _, bad = contracts.split(fx.leads_raw(spark, sf), contracts.bronze_rules())
    return tidy(bad.select("src_key", "customer_id", "age", "duration", "campaign"))


@query("ctr_quarantine_reason", f"""
SELECT src_key, concat_ws('; ', {', '.join(f"CASE WHEN {t} THEN '{r}' END" for r, t in _BAD.items())}) AS reason
FROM leads_raw WHERE {_ANY_BAD}""", ("leads_raw",))
def ctr_quarantine_reason(spark, sf):
    _, bad = contracts.split(fx.leads_raw(spark, sf), contracts.bronze_rules())
    return bad.select("src_key", F.col(contracts.REASON).alias("reason"))


@query("ctr_bronze_rules", _counts(_BAD, "leads_raw"), ("leads_raw",))
def ctr_bronze_rules(spark, sf):
    return contracts.violation_counts(fx.leads_raw(spark, sf), contracts.bronze_rules())


@query("ctr_dim_customer", f"""
WITH {_CLEAN_ALL}, candidates AS (
  SELECT DISTINCT customer_id, age, job, marital, education, in_default, balance, housing, loan FROM leads_clean)
{_counts({
    'customer_id_present': 'customer_id IS NULL',
    'age_range': 'age IS NULL OR age NOT BETWEEN 18 AND 105',
    'job_domain': f'coalesce(job NOT IN ({_JOBS}), TRUE)',
    'marital_domain': "coalesce(marital NOT IN ('married','single','divorced'), TRUE)",
    'education_domain': "coalesce(education NOT IN ('primary','secondary','tertiary','unknown'), TRUE)",
    'default_domain': "coalesce(in_default NOT IN ('yes','no'), TRUE)",
    'balance_number': 'balance IS NULL',
    'housing_domain': "coalesce(housing NOT IN ('yes','no'), TRUE)",
    'loan_domain': "coalesce(loan NOT IN ('yes','no'), TRUE)",
    'customer_id_unique': 'customer_id IN (SELECT customer_id FROM candidates GROUP BY customer_id HAVING count(*) > 1)',
}, 'candidates')}""", ("leads_dup",))
def ctr_dim_customer(spark, sf):
    columns = ("customer_id", "age", "job", "marital", "education", "default", "balance", "housing", "loan")
    candidates = clean_strings(fx.leads_dup(spark, sf).select(*columns)).distinct()
    counts = contracts.violation_counts(candidates, contracts.customer_rules())
    return counts.unionByName(contracts.unique_violation_count(candidates, "customer_id"))


@query("ctr_unique_rows", f"""
WITH {_CLEAN_ALL}, candidates AS (SELECT DISTINCT customer_id, balance FROM leads_clean)
SELECT customer_id, round(balance, 6) AS balance FROM (
  SELECT *, count(*) OVER (PARTITION BY customer_id) AS n FROM candidates) WHERE n > 1""", ("leads_dup",))
def ctr_unique_rows(spark, sf):
    candidates = fx.leads_dup(spark, sf).select("customer_id", "balance").distinct()
    return tidy(contracts.unique_violations(candidates, "customer_id"))


@query("ctr_fact_interaction", f"""
WITH {_CLEAN_ALL}, facts AS (
  SELECT *, concat_ws('|', customer_id, contact, CAST(day AS VARCHAR), month,
                      coalesce(CAST(CAST(duration AS DECIMAL(38,10)) AS VARCHAR), '~'), CAST(campaign AS VARCHAR)) AS ikey
  FROM leads_clean)
{_counts({
    'interaction_id_present': 'ikey IS NULL',
    'customer_id_present': 'customer_id IS NULL',
    'contact_domain': "coalesce(contact NOT IN ('cellular','telephone','unknown'), TRUE)",
    'day_range': 'day IS NULL OR day NOT BETWEEN 1 AND 31',
    'month_domain': f'coalesce(month NOT IN ({_MONTHS}), TRUE)',
    'duration_range': 'duration IS NULL OR duration < 0',
    'campaign_range': 'campaign IS NULL OR campaign < 1',
    'pdays_range': 'pdays IS NULL OR pdays < -1',
    'previous_range': 'previous IS NULL OR previous < 0',
    'poutcome_domain': "coalesce(poutcome NOT IN ('unknown','failure','other','success'), TRUE)",
    'interaction_id_unique': 'ikey IN (SELECT ikey FROM facts GROUP BY ikey HAVING count(*) > 1)',
}, 'facts')}""", ("leads_dup",))
def ctr_fact_interaction(spark, sf):
    cleaned = clean_strings(fx.leads_dup(spark, sf))
    facts = cleaned.withColumn("interaction_id", surrogate_id("INT_", INTERACTION_KEY, numbers=("duration",)))
    counts = contracts.violation_counts(facts, contracts.interaction_rules())
    return counts.unionByName(contracts.unique_violation_count(facts, "interaction_id"))


@query("ctr_lead_payload", _counts({
    "age_range": "age NOT BETWEEN 18 AND 105",
    **{f"{c}_present": f"{'in_default' if c == 'default' else c} IS NULL"
       for c in ("job", "marital", "education", "default", "housing", "loan")},
    "balance_number": "balance IS NULL",
    "day_range": "coalesce(day, 15) NOT BETWEEN 1 AND 31",
    "duration_range": "coalesce(duration, 0) < 0",
    "campaign_range": "coalesce(campaign, 1) < 1",
    "pdays_range": "coalesce(pdays, -1) < -1",
    "previous_range": "coalesce(previous, 0) < 0",
}, "leads_raw"), ("leads_raw",))
def ctr_lead_payload(spark, sf):
    leads = fill_lead_defaults(fx.leads_raw(spark, sf).drop("y"))
    return contracts.violation_counts(leads, contracts.lead_rules())


@query("ctr_feedback", """
SELECT feedback_id, outcome, concat_ws('; ', CASE WHEN call_duration < 0 THEN 'call_duration_range' END,
       CASE WHEN outcome NOT IN ('agreed','declined','callback','unreachable') THEN 'outcome_domain' END) AS reason
FROM call_feedback""", ("call_feedback",))
def ctr_feedback(spark, sf):
    checked = contracts.check(fx.call_feedback(spark, sf), contracts.feedback_rules())
    return checked.select("feedback_id", "outcome", F.col(contracts.REASON).alias("reason"))


@query("ctr_ratio_gate", f"""
SELECT total_rows, quarantined_rows, round(quarantined_rows / CAST(total_rows AS DOUBLE), 6) AS quarantine_ratio,
       quarantined_rows / CAST(total_rows AS DOUBLE) <= 0.1 AS within_limit FROM (
  SELECT count(*) AS total_rows, count(*) FILTER (WHERE {_ANY_BAD}) AS quarantined_rows FROM leads_raw)""", ("leads_raw",))
def ctr_ratio_gate(spark, sf):
    return tidy(contracts.quarantine_ratio(fx.leads_raw(spark, sf), contracts.bronze_rules()))
