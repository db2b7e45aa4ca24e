"""Registered queries: profiling, exploratory aggregates, bins and rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake.functions.encode import target_flag
from leadlake.operators import bins, profile, score
from leadlake.plans import fixtures as fx
from leadlake.plans.catalogue import query, tidy

NUMBERS = ("age", "balance", "day", "duration", "campaign", "pdays", "previous")
TEXTS = ("job", "marital", "education", "default", "housing", "loan", "contact", "month", "poutcome", "y")
_SQL = {"default": "in_default"}
INF = float("inf")


def _each(columns, template: str, source: str = "leads_raw") -> str:
    """One SELECT per column: the plain way, which the operators avoid."""
    return " UNION ALL ".join(
        template.format(name=c, c=_SQL.get(c, c), source=source) for c in columns)


def labelled(spark, sf):
    return fx.leads_raw(spark, sf).withColumn("label", target_flag(F.col("y")))


def safe(df):
    return df.withColumnRenamed("default", "in_default") if "default" in df.columns else df


@query("agg_value_counts", """
SELECT job AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM leads_raw), 6)::DOUBLE AS pct
FROM leads_raw GROUP BY job""", ("leads_raw",))
def agg_value_counts(spark, sf):
    return tidy(profile.value_counts(fx.leads_raw(spark, sf), "job"))


@query("agg_month_counts", """
SELECT month, count(*) AS n, CAST(min(date_part('month', event_ts)) AS INTEGER) AS month_no FROM leads_raw
GROUP BY month ORDER BY month_no""", ("leads_raw",))
def agg_month_counts(spark, sf):
    return profile.month_counts(fx.leads_raw(spark, sf))


_DESCRIBE = """count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  round(min({c})::DOUBLE, 4) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25,
  round(quantile_cont({c}::DOUBLE, 0.5), 4) AS q50, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75,
  round(max({c})::DOUBLE, 4) AS max"""


@query("prof_numeric", _each(NUMBERS, "SELECT '{name}' AS feature, " + _DESCRIBE + " FROM {source}"), ("leads_raw",))
def prof_numeric(spark, sf):
    return tidy(profile.describe_numeric(fx.leads_raw(spark, sf), NUMBERS), 4)


_ITEMS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("prof_numeric_lineitem", _each(_ITEMS, "SELECT '{name}' AS feature, " + _DESCRIBE + " FROM {source}", "lineitem"))
def prof_numeric_lineitem(spark, sf):
    return tidy(profile.describe_numeric(fx.table(spark, sf, "lineitem"), _ITEMS), 4)


@query("prof_categorical", _each(TEXTS, """
SELECT '{name}' AS feature, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
       (list({c} ORDER BY n DESC, {c}))[1] AS top, max(n) AS freq
FROM (SELECT {c}, count(*) AS n FROM {source} GROUP BY {c})"""), ("leads_raw",))
def prof_categorical(spark, sf):
    return profile.describe_categorical(fx.leads_raw(spark, sf), TEXTS)


_PROFILE_TYPES = {
    **{c: "string" for c in ("customer_id", "phone", *TEXTS)},
    **{c: "int" for c in ("age", "day", "campaign", "pdays", "previous")}, "balance": "double", "duration": "double",
}


@query("prof_schema", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, '{t}' AS dtype, count(DISTINCT {_SQL.get(c, c)}) AS distinct_values,
       count(*) - count({_SQL.get(c, c)}) AS missing,
       CASE WHEN '{c}' = 'y' THEN 'Binary' WHEN '{t}' <> 'string' THEN 'Numerical'
            WHEN count(DISTINCT {_SQL.get(c, c)}) = 2 THEN 'Binary' ELSE 'Categorical' END AS logical_type,
       CASE WHEN '{c}' = 'y' THEN 'Target' ELSE 'Feature' END AS role FROM leads_raw"""
                               for c, t in _PROFILE_TYPES.items()), ("leads_raw",))
def prof_schema(spark, sf):
    return profile.schema_profile(fx.leads_raw(spark, sf).select(*_PROFILE_TYPES), "y")


@query("prof_schema_sketch")
def prof_schema_sketch(spark, sf):
    return profile.schema_profile(fx.leads_raw(spark, sf).select(*_PROFILE_TYPES), "y", approximate=True)


@query("prof_shape", "SELECT count(*) AS n_rows, CAST(21 AS BIGINT) AS n_columns FROM leads_raw", ("leads_raw",))
def prof_shape(spark, sf):
    return profile.shape(fx.leads_raw(spark, sf))


@query("prof_unknown", _each(TEXTS, """
SELECT '{name}' AS feature, count(*) FILTER (WHERE {c} = 'unknown') AS n,
       round(count(*) FILTER (WHERE {c} = 'unknown') * 100.0::DOUBLE / count(*), 6) AS pct FROM {source}"""), ("leads_raw",))
def prof_unknown(spark, sf):
    return tidy(profile.unknown_counts(fx.leads_raw(spark, sf), TEXTS))


@query("prof_missing", _each((*NUMBERS, *TEXTS), """
SELECT '{name}' AS feature, count(*) - count({c}) AS n,
       round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS pct FROM {source}"""), ("leads_raw",))
def prof_missing(spark, sf):
    return tidy(profile.missing_counts(fx.leads_raw(spark, sf), (*NUMBERS, *TEXTS)))


@query("prof_duplicates", """
WITH delivered AS (SELECT * FROM leads_raw UNION ALL SELECT * FROM leads_raw WHERE pdays > -1)
SELECT (SELECT count(*) FROM delivered) - (SELECT count(*) FROM (SELECT DISTINCT * FROM delivered)) AS duplicates""", ("leads_raw",))
def prof_duplicates(spark, sf):
    """All leads, those contacted before delivered twice unchanged: whole rows are compared."""
    leads = fx.leads_raw(spark, sf)
    return profile.duplicate_rows(leads.unionByName(leads.filter("pdays > -1")))


@query("agg_group_describe", _each(("age", "balance", "duration"),
       "SELECT '{name}' AS feature, y, " + _DESCRIBE + " FROM {source} GROUP BY y"), ("leads_raw",))
def agg_group_describe(spark, sf):
    return tidy(profile.describe_numeric(fx.leads_raw(spark, sf), ("age", "balance", "duration"), by=("y",)), 4)


@query("agg_group_means", f"""
SELECT y, {', '.join(f'round(avg({c}), 4) AS mean_{c}' for c in NUMBERS)} FROM leads_raw GROUP BY y""", ("leads_raw",))
def agg_group_means(spark, sf):
    return tidy(profile.group_means(fx.leads_raw(spark, sf), "y", NUMBERS), 4)


@query("agg_crosstab", "SELECT job, y, count(*) AS n FROM leads_raw GROUP BY job, y", ("leads_raw",))
def agg_crosstab(spark, sf):
    return profile.crosstab(fx.leads_raw(spark, sf), "job", "y")


@query("agg_crosstab_wide", """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O,
       count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY o_orderpriority""")
def agg_crosstab_wide(spark, sf):
    return profile.crosstab_wide(fx.table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("agg_crosstab_pct", """
SELECT job, y, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY job), 6) AS pct
FROM leads_raw GROUP BY job, y""", ("leads_raw",))
def agg_crosstab_pct(spark, sf):
    return tidy(profile.crosstab_pct(fx.leads_raw(spark, sf), "job", "y"))


@query("agg_histogram", """
WITH e AS (SELECT min(balance) AS lo, (max(balance) - min(balance)) / 100 AS w FROM leads_raw),
h AS (SELECT CAST(least(floor((balance - lo) / w), 99) AS BIGINT) AS bin, count(*) AS n FROM leads_raw, e GROUP BY 1)
SELECT r.bin, round(lo + r.bin * w, 4) AS lower, round(lo + (r.bin + 1) * w, 4) AS upper, coalesce(n, 0) AS n
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(100)) r CROSS JOIN e LEFT JOIN h ON h.bin = r.bin""", ("leads_raw",))
def agg_histogram(spark, sf):
    return tidy(profile.histogram(fx.leads_raw(spark, sf), "balance", bins=100), 4)


@query("agg_histogram_unit", """
WITH e AS (SELECT min(age) AS lo, max(age) AS hi FROM leads_raw)
SELECT CAST(a - lo AS BIGINT) AS bin, a::DOUBLE AS lower, (a + 1)::DOUBLE AS upper,
       count(*) FILTER (WHERE l.age = a OR (l.age = hi AND a = hi - 1)) AS n
FROM (SELECT unnest(range(lo, hi)) AS a, lo, hi FROM e) LEFT JOIN leads_raw l ON l.age = a OR l.age = a + 1 GROUP BY a, lo, hi""",
       ("leads_raw",))
def agg_histogram_unit(spark, sf):
    return tidy(profile.histogram(fx.leads_raw(spark, sf), "age", width=1.0))


_BOX = """
SELECT '{name}' AS feature, y, round(any_value(q25), 4) AS q25, round(any_value(q50), 4) AS q50, round(any_value(q75), 4) AS q75,
       round(min(v) FILTER (WHERE v >= q25 - 1.5 * (q75 - q25)), 4) AS whisker_low,
       round(max(v) FILTER (WHERE v <= q75 + 1.5 * (q75 - q25)), 4) AS whisker_high,
       count(*) FILTER (WHERE v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25)) AS outliers
FROM (SELECT y, {c}::DOUBLE AS v, quantile_cont({c}::DOUBLE, 0.25) OVER (PARTITION BY y) AS q25,
             quantile_cont({c}::DOUBLE, 0.5) OVER (PARTITION BY y) AS q50,
             quantile_cont({c}::DOUBLE, 0.75) OVER (PARTITION BY y) AS q75 FROM {source} WHERE {c} IS NOT NULL)
GROUP BY y"""


@query("agg_box_stats", _each(("balance", "duration", "previous"), _BOX), ("leads_raw",))
def agg_box_stats(spark, sf):
    return tidy(profile.box_stats(fx.leads_raw(spark, sf), ("balance", "duration", "previous"), by=("y",)), 4)


_IQR = """
SELECT '{name}' AS feature, count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outliers,
       round(count(*) FILTER (WHERE {c} < lo OR {c} > hi) * 100.0::DOUBLE / count(*), 6) AS pct,
       round(any_value(lo), 6) AS lower_bound, round(any_value(hi), 6) AS upper_bound
FROM {source}, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
  SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM {source}))"""


@query("agg_iqr_outliers", _each(NUMBERS, _IQR), ("leads_raw",))
def agg_iqr_outliers(spark, sf):
    return tidy(profile.iqr_outliers(fx.leads_raw(spark, sf), NUMBERS))


@query("agg_class_balance", """
SELECT round(max(n)::DOUBLE / min(n), 6) AS imbalance_ratio, round(max(n) * 100.0::DOUBLE / sum(n), 6) AS majority_baseline_pct
FROM (SELECT y, count(*) AS n FROM leads_raw GROUP BY y)""", ("leads_raw",))
def agg_class_balance(spark, sf):
    return tidy(profile.class_balance(fx.leads_raw(spark, sf), "y"))


@query("agg_tier_counts", """
SELECT CASE WHEN score >= 0.7 THEN 'Tier 1 (Hot - Priority Dispatch)' WHEN score >= 0.45 THEN 'Tier 2 (Warm - Follow Up)'
            WHEN score >= 0.25 THEN 'Tier 3 (Neutral - Low Priority)' ELSE 'Tier 4 (Cold - Do Not Call)' END AS priority_tier,
       count(*) AS n FROM scored GROUP BY 1""", ("scored",))
def agg_tier_counts(spark, sf):
    tiered = fx.scored(spark, sf).withColumn("priority_tier", score.priority_tier(F.col("score")))
    return profile.counts_by(tiered, "priority_tier")


# --- Bins and rates -----------------------------------------------------------------

# --- Fixed values: bin edges -------------------------------------------------
_BALANCE_EDGES = (-INF, 0.0, 100.0, 500.0, 1000.0, 2000.0, 5000.0, 10000.0, INF)
_DURATION_EDGES = (0.0, 60.0, 180.0, 300.0, 600.0, 1800.0, INF)
_BALANCE_BIN = """CASE WHEN balance < 0 THEN 0 WHEN balance < 100 THEN 1 WHEN balance < 500 THEN 2 WHEN balance < 1000 THEN 3
  WHEN balance < 2000 THEN 4 WHEN balance < 5000 THEN 5 WHEN balance < 10000 THEN 6 ELSE 7 END"""
_DURATION_BIN = """CASE WHEN duration IS NULL OR duration < 0 THEN NULL WHEN duration < 60 THEN 0 WHEN duration < 180 THEN 1
  WHEN duration < 300 THEN 2 WHEN duration < 600 THEN 3 WHEN duration < 1800 THEN 4 ELSE 5 END"""


@query("bin_fixed", f"""
SELECT src_key, CAST({_BALANCE_BIN} AS INTEGER) AS balance_bin, CAST({_DURATION_BIN} AS INTEGER) AS duration_bin FROM leads_raw""",
       ("leads_raw",))
def bin_fixed(spark, sf):
    return fx.leads_raw(spark, sf).select(
        "src_key", bins.fixed_bin(F.col("balance"), _BALANCE_EDGES).alias("balance_bin"),
        bins.fixed_bin(F.col("duration"), _DURATION_EDGES).alias("duration_bin"))


def _qcut(column: str, q: int, source: str = "leads_raw") -> str:
    """Bin number by counting the distinct inner edges strictly below the value."""
    shares = ", ".join(str(i / q) for i in range(q + 1))
    return f"""(SELECT s.*, CAST((SELECT count(*) FROM unnest(list_distinct(ed.l[2:-2])) AS u(v)
        WHERE u.v < s.{column} AND u.v > ed.l[1] AND u.v < ed.l[-1]) AS INTEGER) AS bin
      FROM {source} s, (SELECT quantile_cont({column}::DOUBLE, [{shares}]) AS l FROM {source}) ed WHERE s.{column} IS NOT NULL)"""


@query("bin_quantile", f"SELECT src_key, bin FROM {_qcut('age', 5)}", ("leads_raw",))
def bin_quantile(spark, sf):
    df = fx.leads_raw(spark, sf)
    edges = bins.quantile_edges(df, "age", 5)
    return df.select("src_key", bins.quantile_bin(F.col("age"), edges).alias("bin"))


@query("bin_rank_first", """
SELECT src_key, CAST(greatest(ceil((r - 1) * 10 / CAST(n - 1 AS DOUBLE)) - 1, 0) AS INTEGER) AS bin FROM (
  SELECT src_key, row_number() OVER (ORDER BY campaign, src_key) AS r, count(*) OVER () AS n FROM leads_raw)""", ("leads_raw",))
def bin_rank_first(spark, sf):
    df = fx.leads_raw(spark, sf).select("src_key", "campaign")
    return bins.rank_first_bins(df, "campaign", "src_key", 10).select("src_key", "bin")


@query("rate_by_bin", f"""
SELECT * FROM (
SELECT 'balance' AS feature, {_BALANCE_BIN} AS bin, count(*) AS n, round(avg((y = 'yes')::INT) * 100, 6) AS conversion_rate
FROM leads_raw GROUP BY 2
UNION ALL
SELECT 'duration', {_DURATION_BIN}, count(*), round(avg((y = 'yes')::INT) * 100, 6) FROM leads_raw WHERE duration >= 0 GROUP BY 2
UNION ALL
SELECT 'age', bin, count(*), round(avg((y = 'yes')::INT) * 100, 6) FROM {_qcut('age', 5)} GROUP BY 2)""", ("leads_raw",))
def rate_by_bin(spark, sf):
    df = labelled(spark, sf)
    edges = bins.quantile_edges(df, "age", 5)
    binned = {
        "balance": bins.fixed_bin(F.col("balance"), _BALANCE_EDGES),
        "duration": bins.fixed_bin(F.col("duration"), _DURATION_EDGES),
        "age": bins.quantile_bin(F.col("age"), edges),
    }
    long = df.select("label", *[c.alias(n) for n, c in binned.items()]).unpivot(["label"], list(binned), "feature", "bin")
    known = long.filter(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("n"), (F.avg("label") * 100.0).alias("conversion_rate"))
    return tidy(known)


@query("rate_by_category", """
SELECT poutcome, count(*) AS n, round(avg((y = 'yes')::INT) * 100, 6) AS conversion_rate FROM leads_raw
GROUP BY poutcome ORDER BY 3 DESC""", ("leads_raw",))
def rate_by_category(spark, sf):
    return tidy(bins.conversion_rate(labelled(spark, sf), "poutcome", "label"))


@query("rate_by_decile", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, bin, count(*) AS n, round(avg((y = 'yes')::INT) * 100, 6) AS yes_pct,
       round(avg((y = 'no')::INT) * 100, 6) AS no_pct FROM {_qcut(c, 10)} GROUP BY bin""" for c in ("duration", "balance", "campaign")),
       ("leads_raw",))
def rate_by_decile(spark, sf):
    return tidy(bins.decile_rates(labelled(spark, sf), ("duration", "balance", "campaign"), "label"))
