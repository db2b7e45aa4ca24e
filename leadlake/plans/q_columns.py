"""Registered queries: projections, filters, scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake.config import JOBS, LEAD_DEFAULTS, POUTCOMES
from leadlake.functions import encode, features, hashing, numeric, text
from leadlake.operators import conform
from leadlake.plans import fixtures as fx
from leadlake.plans.catalogue import query, tidy
from leadlake.plans.lakehouse import cast_contract


@query("col_normalise_names", "SELECT src_key, age, job, y FROM leads_raw", ("leads_raw",))
def col_normalise_names(spark, sf):
    df = fx.leads_raw(spark, sf).select("src_key", "age", "job", "y")
    return text.normalise_names(df.toDF(*[f" {c.title()} " for c in df.columns]))


@query("col_rename_map", "SELECT src_key AS key, age AS tuoi, job AS nghe_nghiep, y AS dang_ky FROM leads_raw", ("leads_raw",))
def col_rename_map(spark, sf):
    df = fx.leads_raw(spark, sf).select("src_key", "age", "job", "y")
    return text.rename_columns(df, {"src_key": "key", "age": "tuoi", "job": "nghe_nghiep", "y": "dang_ky"})


@query("col_project", """
SELECT src_key, age, round(balance, 6) AS balance, day, round(duration, 6) AS duration, campaign, previous
FROM leads_raw""", ("leads_raw",))
def col_project(spark, sf):
    df = fx.leads_raw(spark, sf)
    return tidy(df.select(*text.numeric_columns(df)).drop("pdays"))


@query("str_clean_all", """
SELECT src_key, trim(customer_id) AS customer_id, lower(trim(job)) AS job, lower(trim(marital)) AS marital,
       lower(trim(education)) AS education, lower(trim(contact)) AS contact, lower(trim(month)) AS month,
       lower(trim(poutcome)) AS poutcome, lower(trim(y)) AS y, lower(trim(phone)) AS phone,
       lower(trim(in_default)) AS in_default, lower(trim(housing)) AS housing, lower(trim(loan)) AS loan
FROM leads_raw""", ("leads_raw",))
def str_clean_all(spark, sf):
    df = fx.leads_raw(spark, sf)
    return tidy(text.clean_strings(df).select("src_key", *text.string_columns(df)))


@query("str_clean_lead", """
SELECT src_key, lower(trim(job)) AS job, lower(trim(marital)) AS marital, lower(trim(month)) AS month, phone
FROM leads_raw""", ("leads_raw",))
def str_clean_lead(spark, sf):
    return text.clean_lead_strings(fx.leads_raw(spark, sf)).select("src_key", "job", "marital", "month", "phone")


@query("cast_contract", """
SELECT src_key, age, round(balance, 6) AS balance, round(duration, 6) AS duration, campaign, pdays FROM leads_raw""",
       ("leads_raw",))
def cast_contract_query(spark, sf):
    raw = fx.leads_raw(spark, sf)
    as_text = raw.select("src_key", *[F.col(c).cast("string").alias(c) for c in
                                      ("age", "balance", "duration", "campaign", "pdays")])
    return tidy(cast_contract(as_text))


@query("cast_coerce_numeric", """
SELECT src_key, round(TRY_CAST(v AS DOUBLE), 6) AS value FROM (
  SELECT src_key, CASE WHEN poutcome = 'other' THEN poutcome ELSE CAST(duration AS VARCHAR) END AS v FROM leads_raw
) WHERE TRY_CAST(v AS DOUBLE) IS NOT NULL""", ("leads_raw",))
def cast_coerce_numeric(spark, sf):
    mixed = F.when(F.col("poutcome") == "other", F.col("poutcome")).otherwise(F.col("duration").cast("string"))
    df = fx.leads_raw(spark, sf).select("src_key", mixed.alias("value"))
    coerced = df.withColumn("value", numeric.coerce_double("value"))
    return tidy(coerced.filter(F.col("value").isNotNull()))


@query("flt_range", "SELECT src_key, age FROM leads_raw WHERE age >= 18 AND age <= 105 AND duration >= 0", ("leads_raw",))
def flt_range(spark, sf):
    keep = numeric.within(F.col("age"), 18, 105) & numeric.within(F.col("duration"), 0)
    return fx.leads_raw(spark, sf).filter(keep).select("src_key", "age")


@query("flt_domain", """
SELECT src_key, job, poutcome FROM leads_raw
WHERE job NOT IN (' Admin. ', 'Management') AND poutcome IN ('unknown', 'failure', 'other', 'success')""", ("leads_raw",))
def flt_domain(spark, sf):
    keep = numeric.member(F.col("job"), JOBS) & numeric.member(F.col("poutcome"), POUTCOMES)
    return fx.leads_raw(spark, sf).filter(keep).select("src_key", "job", "poutcome")


@query("flt_sentinel", "SELECT src_key, pdays, previous FROM leads_raw WHERE pdays <> -1", ("leads_raw",))
def flt_sentinel(spark, sf):
    return fx.leads_raw(spark, sf).filter(F.col("pdays") > -1).select("src_key", "pdays", "previous")


@query("null_unknown", """
SELECT src_key, CASE WHEN job <> 'unknown' THEN job END AS job, CASE WHEN education <> 'unknown' THEN education END AS education,
       CASE WHEN contact <> 'unknown' THEN contact END AS contact, CASE WHEN poutcome <> 'unknown' THEN poutcome END AS poutcome
FROM leads_raw""", ("leads_raw",))
def null_unknown(spark, sf):
    df = fx.leads_raw(spark, sf).select("src_key", "job", "education", "contact", "poutcome")
    return text.unknown_to_null(df)


@query("lead_defaults", """
SELECT src_key, customer_id, CASE WHEN duration IS NULL THEN 0.0 ELSE round(duration, 6) END AS duration,
       CASE WHEN contact = 'unknown' THEN 'unknown' ELSE contact END AS contact,
       CAST(15 AS INTEGER) AS day, 'may' AS month FROM leads_raw""", ("leads_raw",))
def lead_defaults(spark, sf):
    df = fx.leads_raw(spark, sf).drop("day", "month").withColumn("contact", F.nullif(F.col("contact"), F.lit("unknown")))
    filled = features.fill_lead_defaults(df)
    assert set(LEAD_DEFAULTS) <= set(filled.columns)
    return tidy(filled.select("src_key", "customer_id", "duration", "contact", "day", "month"))


@query("bkt_campaign_pressure", """
SELECT src_key, campaign, CASE campaign WHEN 1 THEN '1 call' WHEN 2 THEN '2-3 calls' WHEN 3 THEN '2-3 calls'
       ELSE '4+ calls' END AS bucket FROM leads_raw""", ("leads_raw",))
def bkt_campaign_pressure(spark, sf):
    return fx.leads_raw(spark, sf).select("src_key", "campaign", features.pressure_bucket(F.col("campaign")).alias("bucket"))


@query("feat_balance_tier", """
SELECT src_key, CASE WHEN balance > 5000 THEN 'high_5k_plus' WHEN balance > 1000 THEN 'mid_1k_5k'
       WHEN balance >= 0 THEN 'low_0_1k' ELSE 'negative' END AS balance_tier FROM leads_raw""", ("leads_raw",))
def feat_balance_tier(spark, sf):
    return fx.leads_raw(spark, sf).select("src_key", features.balance_tier(F.col("balance")).alias("balance_tier"))


@query("feat_pdays_group", """
SELECT src_key, CASE WHEN pdays > 180 THEN 'long_ago_gt_180d' WHEN pdays > 30 THEN 'mid_31_180d'
       WHEN pdays > -1 THEN 'recent_le_30d' ELSE 'never' END AS pdays_group FROM leads_raw""", ("leads_raw",))
def feat_pdays_group(spark, sf):
    return fx.leads_raw(spark, sf).select("src_key", features.pdays_group(F.col("pdays")).alias("pdays_group"))


@query("feat_fin_pressure", """
SELECT src_key, CAST(2 * (in_default = 'yes')::INT + (housing = 'yes')::INT + (loan = 'yes')::INT AS INTEGER) AS idx
FROM leads_raw""", ("leads_raw",))
def feat_fin_pressure(spark, sf):
    c = F.col
    return fx.leads_raw(spark, sf).select(
        "src_key", features.financial_pressure(c("default"), c("housing"), c("loan")).alias("idx"))


@query("feat_campaign_ratio", """
SELECT src_key, round(campaign / CAST(previous + 1 AS DOUBLE), 3) AS ratio FROM leads_raw""", ("leads_raw",))
def feat_campaign_ratio(spark, sf):
    return fx.leads_raw(spark, sf).select(
        "src_key", features.campaign_ratio(F.col("campaign"), F.col("previous")).alias("ratio"))


@query("feat_flags", """
SELECT src_key, CAST(pdays <> -1 AS INTEGER) AS is_previously_contacted,
       CAST(poutcome = 'success' AS INTEGER) AS past_success_flag FROM leads_raw""", ("leads_raw",))
def feat_flags(spark, sf):
    return fx.leads_raw(spark, sf).select(
        "src_key", features.previously_contacted(F.col("pdays")).alias("is_previously_contacted"),
        features.past_success(F.col("poutcome")).alias("past_success_flag"))


@query("feat_derive_leads", """
SELECT src_key, lower(trim(job)) AS job, round(coalesce(duration, 0), 6) AS duration,
       CASE WHEN balance > 5000 THEN 'high_5k_plus' WHEN balance > 1000 THEN 'mid_1k_5k'
            WHEN balance >= 0 THEN 'low_0_1k' ELSE 'negative' END AS balance_tier,
       CASE WHEN pdays > 180 THEN 'long_ago_gt_180d' WHEN pdays > 30 THEN 'mid_31_180d'
            WHEN pdays > -1 THEN 'recent_le_30d' ELSE 'never' END AS pdays_group,
       CAST(2 * (in_default = 'yes')::INT + (housing = 'yes')::INT + (loan = 'yes')::INT AS INTEGER) AS financial_pressure_index,
       round(campaign / CAST(previous + 1 AS DOUBLE), 3) AS campaign_pressure_ratio,
       CAST(pdays <> -1 AS INTEGER) AS is_previously_contacted, CAST(poutcome = 'success' AS INTEGER) AS past_success_flag
FROM leads_raw""", ("leads_raw",))
def feat_derive_leads(spark, sf):
    return tidy(features.derive_leads(fx.leads_raw(spark, sf).drop("y")).select(
        "src_key", "job", "duration", "balance_tier", "pdays_group", "financial_pressure_index",
        "campaign_pressure_ratio", "is_previously_contacted", "past_success_flag"))


_HASH = """md5(concat(CAST(CAST(age AS DECIMAL(38,10)) AS VARCHAR), '_', job, '_',
       CAST(CAST(balance AS DECIMAL(38,10)) AS VARCHAR), '_', CAST(CAST(day AS DECIMAL(38,10)) AS VARCHAR), '_', month))"""


@query("hash_record", f"SELECT src_key, {_HASH} AS record_hash FROM leads_raw", ("leads_raw",))
def hash_record(spark, sf):
    return fx.leads_raw(spark, sf).select("src_key", hashing.record_hash().alias("record_hash"))


@query("audit_columns", f"""
SELECT src_key, 'batch-1' AS _batch_id, TRUE AS stamped, 'leads.parquet' AS _source_file, {_HASH} AS _record_hash FROM leads_raw""",
       ("leads_raw",))
def audit_columns(spark, sf):
    audited = conform.add_audit(fx.leads_raw(spark, sf), "batch-1", "leads.parquet")
    recent = F.current_timestamp() - F.col("_ingested_at") < F.expr("INTERVAL 1 HOUR")
    return audited.select("src_key", "_batch_id", recent.alias("stamped"), "_source_file", "_record_hash")


@query("id_surrogate", """
SELECT src_key, concat('INT_', sha256(concat(customer_id, '|', contact, '|', day, '|', month, '|',
       coalesce(CAST(CAST(duration AS DECIMAL(38,10)) AS VARCHAR), '~'), '|', campaign))) AS interaction_id
FROM leads_raw""", ("leads_raw",))
def id_surrogate(spark, sf):
    key = ("customer_id", "contact", "day", "month", "duration", "campaign")
    return fx.leads_raw(spark, sf).select(
        "src_key", hashing.surrogate_id("INT_", key, numbers=("duration",)).alias("interaction_id"))


@query("enc_binary", """
SELECT src_key, CAST(in_default = 'yes' AS INTEGER) AS in_default, CAST(housing = 'yes' AS INTEGER) AS housing,
       CAST(loan = 'yes' AS INTEGER) AS loan FROM leads_raw""", ("leads_raw",))
def enc_binary(spark, sf):
    return tidy(fx.leads_raw(spark, sf).select(
        "src_key", *[encode.yes_no_flag(F.col(c)).alias(c) for c in ("default", "housing", "loan")]))


@query("enc_target", "SELECT src_key, CAST(y = 'yes' AS INTEGER) AS y, CAST(y = 'yes' AS INTEGER) AS y_coded FROM leads_raw", ("leads_raw",))
def enc_target(spark, sf):
    coded = F.when(F.col("y") == "yes", "2").otherwise("1")
    return fx.leads_raw(spark, sf).select(
        "src_key", encode.target_flag(F.col("y")).alias("y"), encode.target_flag(coded).alias("y_coded"))


@query("enc_month", """
SELECT src_key, CAST(date_part('month', event_ts) AS INTEGER) AS month_no FROM leads_raw""", ("leads_raw",))
def enc_month(spark, sf):
    return fx.leads_raw(spark, sf).select("src_key", encode.month_number(F.upper("month")).alias("month_no"))


@query("num_clip", """
SELECT src_key, round(CASE WHEN balance < 0 THEN 0 WHEN balance > 5000 THEN 5000 ELSE balance END, 6) AS balance,
       round(CASE WHEN duration IS NULL THEN NULL WHEN duration < 10 THEN 10 WHEN duration > 900 THEN 900 ELSE duration END, 6) AS duration
FROM leads_raw""", ("leads_raw",))
def num_clip(spark, sf):
    return tidy(fx.leads_raw(spark, sf).select(
        "src_key", numeric.clip(F.col("balance"), F.lit(0.0), F.lit(5000.0)).alias("balance"),
        numeric.clip(F.col("duration"), F.lit(10.0), F.lit(900.0)).alias("duration")))


@query("num_band_floor", "SELECT src_key, CAST(floor(balance / 500) * 500 AS DOUBLE) AS band FROM leads_raw", ("leads_raw",))
def num_band_floor(spark, sf):
    return fx.leads_raw(spark, sf).select("src_key", numeric.band_floor(F.col("balance"), 500).alias("band"))
