"""Registered queries: drift, fairness, privacy."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake.functions import hashing, text
from leadlake.operators import drift, fairness, privacy
from leadlake.plans import fixtures as fx
from leadlake.plans.catalogue import query, tidy

SALT = "test-only-salt"
_ITEMS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_CUT = "1998-01-01"


def _psi(feature: str, column: str, baseline: str, incoming: str) -> str:
    inner = ", ".join(str(i / 10) for i in range(1, 10))
    return f"""
SELECT '{feature}' AS feature, round(sum((a - e) * ln(a / e)), 4) AS psi FROM (
  SELECT e0 / sum(e0) OVER () AS e, a0 / sum(a0) OVER () AS a FROM (
  SELECT greatest(en / sum(en) OVER (), 1e-4) AS e0, greatest(an / sum(an) OVER (), 1e-4) AS a0 FROM (
    SELECT b.bin, coalesce(max(n) FILTER (WHERE side = 'e'), 0)::DOUBLE AS en, coalesce(max(n) FILTER (WHERE side = 'a'), 0)::DOUBLE AS an
    FROM (SELECT unnest(range(len(l) + 1)) AS bin FROM (
            SELECT list_distinct(quantile_cont({column}::DOUBLE, [{inner}])) AS l FROM {baseline})) b
    LEFT JOIN (
      SELECT side, (SELECT count(*) FROM unnest(l) AS u(edge) WHERE edge <= v) AS bin, count(*) AS n FROM (
        SELECT 'e' AS side, {column}::DOUBLE AS v FROM {baseline} UNION ALL SELECT 'a', {column}::DOUBLE FROM {incoming}),
        (SELECT list_distinct(quantile_cont({column}::DOUBLE, [{inner}])) AS l FROM {baseline})
      WHERE v IS NOT NULL GROUP BY side, 2) c ON c.bin = b.bin GROUP BY b.bin)))"""


_SIDES = f"""WITH old AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{_CUT}'),
new AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{_CUT}')"""


def _lineitem(spark, sf):
    df = fx.table(spark, sf, "lineitem")
    cut = F.to_timestamp_ntz(F.lit(_CUT))
    return df.filter(F.col("l_shipdate") < cut), df.filter(F.col("l_shipdate") >= cut)


@query("mon_psi", f"{_SIDES} {' UNION ALL '.join(_psi(c, c, 'old', 'new') for c in _ITEMS)}")
def mon_psi(spark, sf):
    old, new = _lineitem(spark, sf)
    return drift.psi_by_feature(old, new, _ITEMS)


_BASE = "(SELECT age, balance, day, campaign FROM leads_raw WHERE poutcome = 'unknown')"
_NEXT = "(SELECT age + 25 AS age, balance + 300.0 AS balance, day, campaign * 2 AS campaign FROM leads_raw WHERE poutcome <> 'unknown')"


@query("mon_drift_report", f"""
WITH base AS {_BASE}, incoming AS {_NEXT},
p AS ({' UNION ALL '.join(_psi(c, c, 'base', 'incoming') for c in ('age', 'balance', 'day', 'campaign'))})
SELECT feature, psi, CASE WHEN psi >= 0.25 THEN 'SIGNIFICANT_DRIFT' WHEN psi >= 0.1 THEN 'MODERATE_SHIFT' ELSE 'STABLE' END AS status,
       psi >= 0.25 AS is_drifted, CAST(4 AS BIGINT) AS features_evaluated, 0.25::DOUBLE AS psi_threshold,
       (SELECT max(psi) >= 0.25 FROM p) AS drift_detected, (SELECT max(psi) >= 0.25 FROM p) AS retrain_recommended FROM p""", ("leads_raw",))
def mon_drift_report(spark, sf):
    leads = fx.leads_raw(spark, sf)
    base = leads.filter("poutcome = 'unknown'")
    incoming = leads.filter("poutcome <> 'unknown'").withColumns({
        "age": F.col("age") + 25, "balance": F.col("balance") + 300.0, "campaign": F.col("campaign") * 2})
    return drift.drift_report(base, incoming)


_DECIDED = """SELECT *, (score >= 0.45)::INT AS decision FROM scored"""


def _groups(test: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE g)::DOUBLE AS pn, count(*) FILTER (WHERE NOT g)::DOUBLE AS un,
  avg(decision) FILTER (WHERE g) AS pr, avg(decision) FILTER (WHERE NOT g) AS ur,
  coalesce(avg(decision) FILTER (WHERE g AND label = 1), 0) AS pt, coalesce(avg(decision) FILTER (WHERE NOT g AND label = 1), 0) AS ut
FROM (SELECT *, {test} AS g FROM ({_DECIDED}))"""


_METRICS = "CASE WHEN coalesce(ur, 0) = 0 THEN 1.0 ELSE round(coalesce(pr, 0) / ur, 4) END AS dir, round(pt - ut, 4) AS eod"


def _decided(spark, sf):
    return fx.scored(spark, sf).withColumn("decision", (F.col("score") >= 0.45).cast("int"))


@query("fair_dir", f"SELECT dir AS disparate_impact_ratio FROM (SELECT {_METRICS} FROM ({_groups('age >= 60')}))", ("scored",))
def fair_dir(spark, sf):
    return fairness.disparate_impact(_decided(spark, sf), "age", "label", "decision")


@query("fair_eod", f"SELECT eod AS equal_opportunity_difference FROM (SELECT {_METRICS} FROM ({_groups('age >= 60')}))", ("scored",))
def fair_eod(spark, sf):
    return fairness.equal_opportunity(_decided(spark, sf), "age", "label", "decision")


def _audit(attribute: str, test: str, protected: str, privileged: str) -> str:
    return f"""
SELECT '{attribute}' AS attribute, '{protected}' AS protected_group, '{privileged}' AS privileged_group,
       CAST(pn AS BIGINT) AS protected_count, CAST(un AS BIGINT) AS privileged_count, dir AS disparate_impact_ratio,
       eod AS equal_opportunity_difference, dir BETWEEN 0.8 AND 1.25 AS four_fifths_passed, abs(eod) <= 0.1 AS equal_opportunity_passed,
       CASE WHEN dir BETWEEN 0.8 AND 1.25 AND abs(eod) <= 0.1 THEN 'APPROVED' ELSE 'REQUIRES_MITIGATION' END AS status
FROM (SELECT pn, un, {_METRICS} FROM ({_groups(test)}))"""


@query("fair_audit", f"""
{_audit('age', 'age >= 60', 'Senior (>=60)', 'Non-Senior (<60)')}
UNION ALL {_audit('marital', "marital = 'single'", 'Single', 'Married/Other')}
UNION ALL {_audit('label', 'label = 1', 'Protected', 'Privileged')}
UNION ALL SELECT 'region', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'SKIPPED'""", ("scored",))
def fair_audit(spark, sf):
    return fairness.audit(_decided(spark, sf), ("age", "marital", "label", "region"), "label", "decision")


def _token(column: str) -> str:
    key = SALT.encode().ljust(64, b"\0")
    inner, outer = ("".join(f"{b ^ pad:02x}" for b in key) for pad in (0x36, 0x5C))
    digest = f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || {column}::BLOB)))"
    return f"concat('TOKEN_', substr({digest}, 1, 16))"


@query("pii_tokenise", f"""
SELECT src_key, CASE WHEN poutcome = 'other' THEN 'ANONYMOUS' ELSE {_token('customer_id')} END AS token FROM leads_raw""", ("leads_raw",))
def pii_tokenise(spark, sf):
    some_empty = F.when(F.col("poutcome") == "other", "").otherwise(F.col("customer_id"))
    return fx.leads_raw(spark, sf).select("src_key", hashing.token(some_empty, SALT).alias("token"))


@query("pii_mask_phone", """
SELECT src_key, CASE WHEN length(phone) < 7 THEN '****' ELSE concat(left(phone, 3), '****', right(phone, 3)) END AS phone FROM leads_raw""",
       ("leads_raw",))
def pii_mask_phone(spark, sf):
    return fx.leads_raw(spark, sf).select("src_key", text.mask_phone(F.col("phone")).alias("phone"))


@query("pii_deidentify", f"""
SELECT src_key, {_token('customer_id')} AS customer_id, CAST(floor(balance / 500) * 500 AS DOUBLE) AS balance, age FROM leads_raw""",
       ("leads_raw",))
def pii_deidentify(spark, sf):
    masked = privacy.deidentify(fx.leads_raw(spark, sf), SALT, mask_financials=True)
    return tidy(masked.select("src_key", "customer_id", "balance", "age"))
