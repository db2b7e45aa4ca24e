"""Registered queries: what must hold for models, attributions, scores and runs, row by row.

A fit depends on its optimiser, so its numbers have no SQL text. What every row must satisfy does have one: which rows are
scored, which features exist, that attributions add up, and that tier, action and call flag follow from the probability.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadlake.config import TIER_ACTIONS, TIER_LABELS, Tiers
from leadlake.operators import train
from leadlake.operators.prep import assign_split, model_columns
from leadlake.plans import lakehouse, q_models, q_profile, q_streams
from leadlake.plans.catalogue import query
from leadlake.plans.q_prep import _SPLIT, _U
from leadlake.session import shared_dir
from leadlake.streaming import jobs

_LABEL = "CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS label"
_ROUNDING = 6e-5
_PARTS = f"SELECT *, {_SPLIT} AS split FROM (SELECT *, {_U.format(key='customer_id')} AS u FROM features)"
_TEST = f"SELECT interaction_id, {_LABEL}, TRUE AS in_unit FROM ({_PARTS}) WHERE split = 'test'"


def _in_unit(scores):
    return scores.select("interaction_id", "label", F.col("score").between(0.0, 1.0).alias("in_unit"))


@query("ml_logreg_scores_hold", _TEST, ("features",))
def ml_logreg_scores_hold(spark, sf):
    return _in_unit(q_models.ml_logreg_scores(spark, sf))


@query("ml_gbt_scores_hold", _TEST, ("features",))
def ml_gbt_scores_hold(spark, sf):
    return _in_unit(q_models.ml_gbt_scores(spark, sf))


@query("ml_oversampled_scores_hold", _TEST, ("features",))
def ml_oversampled_scores_hold(spark, sf):
    """Held-out scores of a model fitted without weights on oversampled training rows."""
    rows = q_models._all_rows(spark, sf)
    parts = assign_split(rows, "customer_id")
    model = train.fit_oversampled(parts.filter("split = 'train'"), "post_call", "interaction_id")
    return _in_unit(train.add_probability(model.model, parts.filter("split = 'test'"), "score"))


def _names(mode: str) -> str:
    """Feature names by SQL: numbers, and the levels that the training part holds."""
    numbers, texts = model_columns(mode)
    columns = [(c, "in_default" if c == "default" else c) for c in texts]
    return " UNION ALL ".join([
        *[f"SELECT '{c}' AS feature" for c in numbers],
        *[f"SELECT DISTINCT concat('{c}_', CAST({at} AS VARCHAR)) FROM ({_PARTS}) WHERE split = 'train' AND {at} IS NOT NULL" for c, at in columns]])


@query("ml_coefficients_hold", f"SELECT feature, TRUE AS finite FROM ({_names('post_call')})", ("features",))
def ml_coefficients_hold(spark, sf):
    rows = q_models.ml_coefficients(spark, sf)
    return rows.select("feature", (F.abs("weight") < float("inf")).alias("finite"))


def _on_grid(threshold: Column) -> Column:
    """One of the 91 thresholds."""
    return threshold.between(0.05 - 1e-9, 0.95 + 1e-9) & (F.abs(threshold * 100 - F.round(threshold * 100)) < 1e-6)


@query("ml_registry_hold", "SELECT FALSE AS available_before, TRUE AS available_after, TRUE AS same_scores, TRUE AS on_grid")
def ml_registry_hold(spark, sf):
    row = q_models.ml_registry(spark, sf)
    return row.select("available_before", "available_after", (F.col("max_gap") < 1e-12).alias("same_scores"), _on_grid(F.col("threshold")).alias("on_grid"))


@query("ml_dual_mode_hold", " UNION ALL ".join(
    f"SELECT '{m}' AS mode, {'TRUE' if m == 'post_call' else 'FALSE'} AS uses_duration, (SELECT CAST(count(*) AS INTEGER) FROM ({_names(m)})) AS n_features,"
    " TRUE AS on_grid, TRUE AS useful" for m in ("pre_call", "post_call")), ("features",))
def ml_dual_mode_hold(spark, sf):
    rows = q_models.ml_dual_mode(spark, sf)
    return rows.select("mode", "uses_duration", "n_features", _on_grid(F.col("threshold")).alias("on_grid"),
                       F.col("roc_auc").between(0.0, 1.0).alias("useful"))


_ADDS_UP = "SELECT interaction_id, TRUE AS adds_up FROM features"


def _adds_up(rows):
    return rows.select("interaction_id", (F.abs(F.col("rebuilt_margin") - F.col("margin")) < 1e-6).alias("adds_up"))


@query("xp_linear_local_hold", _ADDS_UP, ("features",))
def xp_linear_local_hold(spark, sf):
    return _adds_up(q_models.xp_linear_local(spark, sf))


@query("xp_tree_local_hold", _ADDS_UP, ("features",))
def xp_tree_local_hold(spark, sf):
    return _adds_up(q_models.xp_tree_local(spark, sf))


@query("xp_top_drivers_hold", "SELECT interaction_id, TRUE AS positive, TRUE AS negative FROM features", ("features",))
def xp_top_drivers_hold(spark, sf):
    rows = q_models.xp_top_drivers(spark, sf)

    def falling(column: str, sign: int) -> Column:
        values = F.transform(column, lambda d: d["impact"] * sign)
        return (F.size(column) <= 3) & F.forall(values, lambda v: v > 0) & (values == F.reverse(F.array_sort(values)))

    return rows.select("interaction_id", falling("positive_drivers", 1).alias("positive"), falling("negative_drivers", -1).alias("negative"))


@query("xp_global_hold", f"""
SELECT CAST(least(10, (SELECT count(*) FROM ({_names('post_call')}))) AS BIGINT) AS n, TRUE AS known, TRUE AS not_negative""", ("features",))
def xp_global_hold(spark, sf):
    names = q_models.trained(spark, sf, "post_call", train.TREES).feature_names
    return q_models.xp_global(spark, sf).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("feature").isin(names)).alias("known"),
        F.bool_and(F.col("importance") >= 0).alias("not_negative"))


def _follows(p: Column, threshold: Column | None) -> Column:
    """Tier, action and call flag are those of the probability, which is known to four digits here."""
    tiers = Tiers()
    near = F.lit(False)
    for bound in tiers.bounds:
        near = near | (F.abs(p - F.lit(bound)) <= _ROUNDING)
    tier = F.when(p >= tiers.bounds[0], TIER_LABELS[0]).when(p >= tiers.bounds[1], TIER_LABELS[1]).when(
        p >= tiers.bounds[2], TIER_LABELS[2]).otherwise(TIER_LABELS[3])
    action = F.element_at(F.create_map(*[F.lit(x) for pair in zip(TIER_LABELS, TIER_ACTIONS) for x in pair]), F.col("priority_tier"))
    flag = F.col("is_recommended_call").isin(0, 1)
    if threshold is not None:
        flag = flag & ((F.col("is_recommended_call") == (p >= threshold).cast("int")) | (F.abs(p - threshold) <= _ROUNDING))
    return p.between(0.0, 1.0) & (near | (F.col("priority_tier") == tier)) & (F.col("telesales_action") == action) & flag


_LEADS = "SELECT src_key, customer_id, TRUE AS follows FROM leads_raw"


def _known() -> Column:
    return F.col("predicted_conversion_prob")


def _by_lead(rows, threshold: Column | None = None):
    return rows.select("src_key", "customer_id", _follows(_known(), threshold).alias("follows"))


@query("sc_batch_score_hold", _LEADS, ("leads_raw",))
def sc_batch_score_hold(spark, sf):
    model = q_models.trained(spark, sf, "post_call", train.TREES)
    return _by_lead(q_models.sc_batch_score(spark, sf), F.lit(model.threshold))


@query("sc_score_file_hold", _LEADS, ("leads_raw",))
def sc_score_file_hold(spark, sf):
    model = q_models.trained(spark, sf, "post_call", train.LOGISTIC)
    return _by_lead(q_models.sc_score_file(spark, sf), F.lit(model.threshold))


@query("pipe_full_hold", _LEADS, ("leads_raw",))
def pipe_full_hold(spark, sf):
    return _by_lead(q_models.pipe_full(spark, sf))


_ROUTED = """SELECT src_key, customer_id, CASE WHEN coalesce(duration, 0) = 0 THEN 'pre_call' ELSE 'post_call' END AS mode, TRUE AS follows
FROM leads_raw"""


def _routed(spark, sf, rows):
    thresholds = {m: model.threshold for m, model in q_models.trained_modes(spark, sf, train.LOGISTIC).items()}
    own = F.when(F.col("mode") == "pre_call", thresholds["pre_call"]).otherwise(thresholds["post_call"])
    return rows.select("src_key", "customer_id", "mode", _follows(_known(), own).alias("follows"))


@query("sc_route_scores_hold", _ROUTED, ("leads_raw",))
def sc_route_scores_hold(spark, sf):
    return _routed(spark, sf, q_models.sc_route_scores(spark, sf))


@query("str_score_hold", _ROUTED, ("leads_raw",))
def str_score_hold(spark, sf):
    return _routed(spark, sf, q_streams.str_score(spark, sf))


_EXPLAINED = """SELECT src_key, customer_id, CASE WHEN coalesce(duration, 0) = 0 THEN 'pre_call' ELSE 'post_call' END AS mode,
       TRUE AS follows, TRUE AS adds_up, TRUE AS names_drivers FROM leads_raw"""


def _explained(spark, sf, rows):
    total = F.aggregate("attributions", F.lit(0.0), lambda s, v: s + v) + F.col("base_margin")
    drivers = F.forall("positive_drivers", lambda d: d["impact"] > 0) & F.forall("negative_drivers", lambda d: d["impact"] < 0)
    return rows.select(
        "src_key", "customer_id", "mode", _follows(_known(), F.col("decision_threshold")).alias("follows"),
        (F.abs(total - F.col("margin")) < 1e-6).alias("adds_up"),
        (drivers & (F.size("positive_drivers") + F.size("negative_drivers") > 0)).alias("names_drivers"))


def _models(spark, sf, kind):
    return q_models.trained_modes(spark, sf, kind)


@query("sc_explained_trees_hold", _EXPLAINED, ("leads_raw",))
def sc_explained_trees_hold(spark, sf):
    """Tree scores with drivers, threshold, tier and action in one row."""
    return _explained(spark, sf, lakehouse.score_leads(q_models._new_leads(spark, sf), _models(spark, sf, train.TREES), explain=True))


@query("str_explained_hold", _EXPLAINED, ("leads_raw",))
def str_explained_hold(spark, sf):
    """The same from a stream, with linear models."""
    path = shared_dir(spark, "stream-explained")
    leads = q_streams._leads_stream(spark, sf).drop("y")
    jobs.drain(jobs.score(leads, _models(spark, sf, train.LOGISTIC), path, shared_dir(spark, "checkpoint"), explain=True))
    return _explained(spark, sf, spark.read.parquet(path))


@query("pipe_daily_hold", " UNION ALL ".join(f"""
SELECT '{m}' AS mode, 'SUCCESS' AS status, (SELECT count(*) FROM bronze) AS ingested_records, (SELECT count(*) FROM dim) AS silver_customers,
       (SELECT count(*) FROM fact) AS silver_interactions, (SELECT count(*) FROM dim) AS deidentified_tokens,
       (SELECT count(*) FROM features) AS feature_records, TRUE AS on_grid, TRUE AS audited""" for m in ("pre_call", "post_call")), ("features",))
def pipe_daily_hold(spark, sf):
    rows = q_models.pipe_daily(spark, sf)
    return rows.select(
        "mode", "status", "ingested_records", "silver_customers", "silver_interactions", "deidentified_tokens", "feature_records",
        _on_grid(F.col("threshold")).alias("on_grid"), F.col("fairness_status").isin("APPROVED", "REQUIRES_MITIGATION").alias("audited"))


@query("prof_schema_sketch_hold", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, '{t}' AS dtype, count(*) - count({q_profile._SQL.get(c, c)}) AS missing, '{'Target' if c == 'y' else 'Feature'}' AS role,
       TRUE AS within FROM leads_raw""" for c, t in q_profile._PROFILE_TYPES.items()), ("leads_raw",))
def prof_schema_sketch_hold(spark, sf):
    """The sketch's distinct counts within four times its stated relative deviation of 0.05."""
    exact = q_profile.prof_schema(spark, sf).select("feature", F.col("distinct_values").alias("exact"))
    sketch = q_profile.prof_schema_sketch(spark, sf)
    off = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(F.col("exact") * 0.2, F.lit(1))
    return sketch.join(exact, "feature").select("feature", "dtype", "missing", "role", off.alias("within"))
