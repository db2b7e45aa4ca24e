"""Registered queries: hypothesis tests, association, feature ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake.functions.encode import target_flag
from leadlake.operators import bins, stats
from leadlake.plans import fixtures as fx
from leadlake.plans.catalogue import query, tidy
from leadlake.plans.q_profile import NUMBERS, labelled

_TEXTS = ("job", "marital", "education", "default", "housing", "loan", "contact", "month", "poutcome")
_TESTED = ("age", "balance", "duration", "campaign")


def _melted(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({'in_default' if c == 'default' else c} AS VARCHAR) AS value, y FROM leads_raw"
        for c in columns)


_MANN_WHITNEY = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, n_0, n_1, round(r - n_0 * (n_0 + 1) / 2, 4) AS u,
       round((greatest(r - n_0 * (n_0 + 1) / 2, n_0::DOUBLE * n_1 - (r - n_0 * (n_0 + 1) / 2)) - n_0::DOUBLE * n_1 / 2 - 0.5)
             / sqrt(n_0::DOUBLE * n_1 / 12 * (n_0 + n_1 + 1 - ties / ((n_0 + n_1)::DOUBLE * (n_0 + n_1 - 1)))), 6) AS z
FROM (SELECT count(*) FILTER (WHERE y = 'no') AS n_0, count(*) FILTER (WHERE y = 'yes') AS n_1,
             sum(mid) FILTER (WHERE y = 'no') AS r, sum(t * t - 1)::DOUBLE AS ties
      FROM (SELECT y, t, rk + (t - 1) / 2.0::DOUBLE AS mid FROM (
              SELECT y, rank() OVER (ORDER BY {c}) AS rk, count(*) OVER (PARTITION BY {c}) AS t
              FROM leads_raw WHERE {c} IS NOT NULL)))""" for c in _TESTED)


@query("test_mann_whitney", _MANN_WHITNEY, ("leads_raw",))
def test_mann_whitney(spark, sf):
    tested = stats.mann_whitney(labelled(spark, sf), _TESTED, "label")
    return tidy(tested.withColumn("u", F.round("u", 4)))


def _upper_gamma(a: str, h: str) -> str:
    """1 - P(a, h) by the power series of the lower incomplete gamma; beyond h = 1000 nothing is left."""
    terms = f"list_sum(list_transform(range(0, 3000), lambda k: exp(({a} + k) * ln({h}) - lgamma({a} + k + 1) - {h})))"
    return f"CASE WHEN {h} <= 0 THEN 1.0 WHEN {h} > 1000 THEN 0.0 ELSE greatest(0.0, 1.0 - {terms}) END"


def _fine(text: str) -> str:
    return text.replace(", 6) AS z", ", 12) AS z").replace(", 6) AS statistic", ", 12) AS statistic")


_VERDICT = "CASE WHEN p < 0.05 THEN 'significant' ELSE 'not significant' END AS verdict"


@query("test_mann_whitney_p", f"""
SELECT feature, round(p, 6) AS p_value, {_VERDICT} FROM (
  SELECT feature, CASE WHEN z < 0 THEN 1.0 ELSE {_upper_gamma('0.5', '(z * z / 2)')} END AS p FROM ({_fine(_MANN_WHITNEY)}))""", ("leads_raw",))
def test_mann_whitney_p(spark, sf):
    tested = stats.mann_whitney_test(labelled(spark, sf), _TESTED, "label")
    return tidy(tested.select("feature", "p_value", "verdict"))


def _chi(cells: str, keys: str = "") -> str:
    """Expected counts for every cell, also the empty ones, then Yates where both sides have two levels."""
    k = f"{keys}, " if keys else ""
    on = " AND ".join(["TRUE", *[f"r.{x} = c.{x}" for x in keys.split(", ") if x]])
    part = f"PARTITION BY {keys}" if keys else ""
    head = "".join(f"r.{x}, " for x in keys.split(", ") if x)
    return f"""
WITH cells AS ({cells}),
r AS (SELECT {k}a, sum(n)::DOUBLE AS rn, count(*) OVER ({part}) AS ka, sum(sum(n)) OVER ({part})::DOUBLE AS total FROM cells GROUP BY {k}a),
c AS (SELECT {k}b, sum(n)::DOUBLE AS cn, count(*) OVER ({part}) AS kb FROM cells GROUP BY {k}b),
g AS (SELECT {head}ka, kb, total, rn * cn / total AS e,
             coalesce((SELECT max(x.n) FROM cells x WHERE x.a = r.a AND x.b = c.b
                       {"".join(f" AND x.{x} = r.{x}" for x in keys.split(", ") if x)}), 0)::DOUBLE AS o
      FROM r JOIN c ON {on})
SELECT {k}round(sum(CASE WHEN (ka - 1) * (kb - 1) = 0 THEN 0 WHEN ka = 2 AND kb = 2
                         THEN power(greatest(abs(o - e) - 0.5, 0), 2) / e ELSE power(o - e, 2) / e END), 6) AS statistic,
       CAST((ka - 1) * (kb - 1) AS BIGINT) AS dof, CAST(total AS BIGINT) AS n_total,
       CAST(ka AS BIGINT) AS levels_a, CAST(kb AS BIGINT) AS levels_b
FROM g GROUP BY {k}ka, kb, total"""


_LABEL_CELLS = f"SELECT feature, value AS a, y AS b, count(*) AS n FROM ({_melted(_TEXTS)}) GROUP BY ALL"


@query("test_chi_square", _chi("SELECT o_orderpriority AS a, o_orderstatus AS b, count(*) AS n FROM orders GROUP BY ALL"))
def test_chi_square(spark, sf):
    return tidy(stats.chi_square(fx.table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus"))


@query("test_chi_square_2x2", _chi("SELECT housing AS a, y AS b, count(*) AS n FROM leads_raw GROUP BY ALL"), ("leads_raw",))
def test_chi_square_2x2(spark, sf):
    return tidy(stats.chi_square(fx.leads_raw(spark, sf), "housing", "y"))


_TAIL = _upper_gamma("(dof / 2.0::DOUBLE)", "(statistic / 2)")


@query("test_chi_square_p", f"""
SELECT dof, round(p, 6) AS p_value, {_VERDICT} FROM (SELECT dof, {_TAIL} AS p FROM ({
_fine(_chi("SELECT o_orderpriority AS a, o_orderstatus AS b, count(*) AS n FROM orders GROUP BY ALL"))}))""")
def test_chi_square_p(spark, sf):
    tested = stats.chi_square_test(fx.table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")
    return tidy(tested.select("dof", "p_value", "verdict"))


@query("rank_chi_square", _chi(_LABEL_CELLS, "feature"), ("leads_raw",))
def rank_chi_square(spark, sf):
    return tidy(stats.rank_chi_square(fx.leads_raw(spark, sf), _TEXTS, "y"))


@query("rank_chi_square_p", f"""
SELECT feature, dof, round(p, 6) AS p_value, {_VERDICT} FROM (SELECT feature, dof, {_TAIL} AS p FROM ({_fine(_chi(_LABEL_CELLS, "feature"))}))""",
       ("leads_raw",))
def rank_chi_square_p(spark, sf):
    tested = stats.rank_chi_square_test(fx.leads_raw(spark, sf), _TEXTS, "y")
    return tidy(tested.select("feature", "dof", "p_value", "verdict"))


@query("rank_cramers_v", f"""
SELECT feature, round(sqrt(greatest(0, statistic / n - (k - 1) * (r - 1) / (n - 1))
         / least(k - (k - 1) * (k - 1) / (n - 1) - 1, r - (r - 1) * (r - 1) / (n - 1) - 1)), 6) AS cramers_v
FROM (SELECT feature, statistic, n_total::DOUBLE AS n, levels_a::DOUBLE AS r, levels_b::DOUBLE AS k
      FROM ({_chi(_LABEL_CELLS, "feature").replace(', 6) AS statistic', ', 12) AS statistic')}))""", ("leads_raw",))
def rank_cramers_v(spark, sf):
    return tidy(stats.cramers_v(fx.leads_raw(spark, sf), _TEXTS, "y"))


_CORR_COLUMNS = (*NUMBERS, "label")
_CORR = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}::DOUBLE, {b}::DOUBLE), 6) AS r FROM l" for a in _CORR_COLUMNS for b in _CORR_COLUMNS)


@query("corr_matrix", f"WITH l AS (SELECT *, (y = 'yes')::INT AS label FROM leads_raw) {_CORR}", ("leads_raw",))
def corr_matrix(spark, sf):
    return tidy(stats.correlation_matrix(labelled(spark, sf), _CORR_COLUMNS))


@query("corr_high_pairs", f"""
WITH l AS (SELECT *, (y = 'yes')::INT AS label FROM leads_raw)
SELECT * FROM ({_CORR}) WHERE a <> b AND abs(r) > 0.3 AND abs(r) < 1""", ("leads_raw",))
def corr_high_pairs(spark, sf):
    return tidy(stats.high_correlations(labelled(spark, sf), _CORR_COLUMNS, above=0.3))


_ENCODED = ("age", "balance", "day", "duration", "campaign", "previous", "in_default", "housing", "loan")


@query("corr_with_target", f"""
WITH l AS (SELECT age, balance, day, duration, campaign, previous, (in_default = 'yes')::INT AS in_default,
           (housing = 'yes')::INT AS housing, (loan = 'yes')::INT AS loan, (y = 'yes')::INT AS label FROM leads_raw)
{' UNION ALL '.join(f"SELECT '{c}' AS feature, round(corr({c}::DOUBLE, label::DOUBLE), 6) AS r FROM l" for c in _ENCODED)}""", ("leads_raw",))
def corr_with_target(spark, sf):
    df = labelled(spark, sf).withColumnRenamed("default", "in_default")
    df = df.withColumns({c: target_flag(F.col(c)) for c in ("in_default", "housing", "loan")})
    return tidy(stats.correlation_with_target(df, _ENCODED, "label"))


_MI_TEXTS = (*_TEXTS, "campaign", "age_bin")
_MI = f"""
WITH q AS (SELECT quantile_cont(age::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS l FROM leads_raw),
m AS ({_melted((*_TEXTS, "campaign"))}
      UNION ALL SELECT 'age_bin', CAST(CAST(age > l[1] AS INT) + CAST(age > l[2] AS INT) + CAST(age > l[3] AS INT)
                                       + CAST(age > l[4] AS INT) AS VARCHAR), y FROM leads_raw, q),
j AS (SELECT feature, value, y, count(*)::DOUBLE AS n FROM m GROUP BY ALL)
SELECT feature, round(sum(n / t * ln(n * t / (r * c))), 6) AS mi FROM (
  SELECT feature, n, sum(n) OVER (PARTITION BY feature, value) AS r, sum(n) OVER (PARTITION BY feature, y) AS c,
         sum(n) OVER (PARTITION BY feature) AS t FROM j) GROUP BY feature"""


def _mi_frame(spark, sf):
    df = fx.leads_raw(spark, sf)
    edges = bins.quantile_edges(df, "age", 5)
    return df.withColumn("age_bin", bins.quantile_bin(F.col("age"), edges))


@query("rank_mutual_info", _MI, ("leads_raw",))
def rank_mutual_info(spark, sf):
    return tidy(stats.mutual_information(_mi_frame(spark, sf), _MI_TEXTS, "y"))


@query("select_features_mi", f"SELECT feature, mi, mi > 0.0005 AS selected FROM ({_MI})", ("leads_raw",))
def select_features_mi(spark, sf):
    return tidy(stats.select_by_mi(_mi_frame(spark, sf), _MI_TEXTS, "y", above=0.0005))


@query("extreme_rows", " UNION ALL ".join(f"""
SELECT '{kind} {c}' AS extreme, src_key, customer_id, job, age, round(balance, 6) AS balance, round(duration, 6) AS duration FROM (
  SELECT * FROM leads_raw WHERE {c} IS NOT NULL ORDER BY {c} {'DESC' if kind == 'max' else 'ASC'}, src_key LIMIT 1)"""
                                          for c in ("age", "balance", "duration") for kind in ("min", "max")), ("leads_raw",))
def extreme_rows(spark, sf):
    df = fx.leads_raw(spark, sf).select("src_key", "customer_id", "job", "age", "balance", "duration")
    return tidy(stats.extreme_rows(df, ("age", "balance", "duration"), "src_key"))


@query("check_leakage", """
SELECT feature, FALSE AS is_target, coalesce(r > 0.999, FALSE) AS perfect_correlation, coalesce(r > 0.999, FALSE) AS leaks FROM (
  SELECT 'age' AS feature, abs(corr(age, (y = 'yes')::INT)) AS r FROM leads_raw
  UNION ALL SELECT 'duration', abs(corr(duration, (y = 'yes')::INT)) FROM leads_raw
  UNION ALL SELECT 'outcome_copy', abs(corr((y = 'yes')::INT * 2, (y = 'yes')::INT)) FROM leads_raw)
UNION ALL SELECT 'label', TRUE, TRUE, TRUE""", ("leads_raw",))
def check_leakage(spark, sf):
    df = labelled(spark, sf).withColumn("outcome_copy", F.col("label") * 2)
    return stats.leakage_report(df, ("age", "duration", "outcome_copy", "label"), "label")
