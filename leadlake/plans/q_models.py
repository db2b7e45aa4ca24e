"""Registered queries: models, attribution, scoring, full runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake.operators import explain, registry, train
from leadlake.plans import fixtures as fx
from leadlake.plans import lakehouse
from leadlake.plans.catalogue import query
from leadlake.plans.q_tables import ORDER, features
from leadlake.operators.prep import assign_split
from leadlake.schemas import LEADS
from leadlake.session import shared_dir
from leadlake.sources import sinks

_LAKES: dict[tuple[str, str], lakehouse.Layers] = {}
_MODELS: dict[tuple[str, str, str, str], train.TrainedModel] = {}


def lake(spark, sf) -> lakehouse.Layers:
    """A lake with its feature table written, made once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LAKES:
        layers = lakehouse.Layers(shared_dir(spark, "model-lake"))
        sinks.overwrite_table(features(spark, sf).drop(*ORDER), layers.features)
        _LAKES[key] = layers
    return _LAKES[key]


def trained(spark, sf, mode: str, model_type: str) -> train.TrainedModel:
    """A model of the whole feature table, trained once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf, mode, model_type)
    if key not in _MODELS:
        _MODELS[key] = train.train_model(spark.read.parquet(lake(spark, sf).features), mode, model_type)
    return _MODELS[key]


def trained_modes(spark, sf, model_type: str) -> dict[str, train.TrainedModel]:
    """The models of both modes; those that are still missing are fitted side by side."""
    keys = {m: (spark.sparkContext.applicationId, sf, m, model_type) for m in lakehouse.MODES}
    missing = [m for m, key in keys.items() if key not in _MODELS]
    if missing:
        made = train.train_models(spark.read.parquet(lake(spark, sf).features), missing, model_type)
        _MODELS.update({keys[m]: model for m, model in made.items()})
    return {m: _MODELS[key] for m, key in keys.items()}


def _held_out(spark, sf):
    rows = train.labelled(spark.read.parquet(lake(spark, sf).features))
    return assign_split(rows, "customer_id").filter("split = 'test'")


def _all_rows(spark, sf):
    """Every interaction, as attributions are wanted for all of them."""
    return train.labelled(spark.read.parquet(lake(spark, sf).features))


def _scores(spark, sf, model_type):
    model = trained(spark, sf, "post_call", model_type)
    scored = train.add_probability(model.model, _held_out(spark, sf))
    return scored.select("interaction_id", "label", F.col("probability_yes").alias("score"))


@query("ml_logreg_scores")
def ml_logreg_scores(spark, sf):
    return _scores(spark, sf, train.LOGISTIC)


@query("ml_gbt_scores")
def ml_gbt_scores(spark, sf):
    return _scores(spark, sf, train.TREES)


@query("ml_coefficients")
def ml_coefficients(spark, sf):
    rows = train.coefficients(trained(spark, sf, "post_call", train.LOGISTIC))
    return spark.createDataFrame(rows, "feature string, weight double")


@query("ml_registry")
def ml_registry(spark, sf):
    """Save two versions, load the active one, and show that its scores are those of the model saved last."""
    root = shared_dir(spark, "registry")
    before = registry.is_model_available(spark, root, "post_call")
    model = trained(spark, sf, "post_call", train.LOGISTIC)
    for version in ("v1", "v2"):
        registry.save_model(spark, model, root, version)
    loaded = registry.load_active_model(spark, root, "post_call")
    old = train.add_probability(model.model, _held_out(spark, sf)).select("interaction_id", "probability_yes")
    new = train.add_probability(loaded.model, _held_out(spark, sf)).select(
        "interaction_id", F.col("probability_yes").alias("reloaded"))
    gap = old.join(new, "interaction_id").agg(F.max(F.abs(F.col("probability_yes") - F.col("reloaded"))).alias("max_gap"))
    return gap.select(F.lit(before).alias("available_before"),
                      F.lit(registry.is_model_available(spark, root, "post_call")).alias("available_after"),
                      F.lit(loaded.threshold).alias("threshold"), "max_gap")


@query("ml_dual_mode")
def ml_dual_mode(spark, sf):
    rows = []
    for mode, model in trained_modes(spark, sf, train.TREES).items():
        rows.append((mode, len(model.feature_names), "duration" in model.feature_names, model.threshold,
                     model.metrics["roc_auc"], model.metrics["pr_auc"], model.metrics["f1_score"]))
    return spark.createDataFrame(
        rows, "mode string, n_features int, uses_duration boolean, threshold double, roc_auc double, pr_auc double, f1_score double")


@query("xp_linear_local")
def xp_linear_local(spark, sf):
    model = trained(spark, sf, "post_call", train.LOGISTIC)
    rows = explain.linear_attributions(model, _all_rows(spark, sf))
    total = F.aggregate("attributions", F.lit(0.0), lambda s, v: s + v)
    return rows.select("interaction_id", "attributions", "base_margin", "margin", (total + F.col("base_margin")).alias("rebuilt_margin"))


def _tree_rows(spark, sf):
    model = trained(spark, sf, "post_call", train.TREES)
    return model, explain.tree_attributions(model, _all_rows(spark, sf), "interaction_id")


@query("xp_tree_local")
def xp_tree_local(spark, sf):
    _, rows = _tree_rows(spark, sf)
    total = F.aggregate("attributions", F.lit(0.0), lambda s, v: s + v)
    return rows.withColumn("rebuilt_margin", total + F.col("base_margin"))


@query("xp_top_drivers")
def xp_top_drivers(spark, sf):
    model, rows = _tree_rows(spark, sf)
    return explain.top_drivers(rows, model.feature_names).select("interaction_id", "positive_drivers", "negative_drivers")


@query("xp_global")
def xp_global(spark, sf):
    model, rows = _tree_rows(spark, sf)
    return explain.global_importance(rows, model.feature_names)


def _new_leads(spark, sf):
    return fx.leads_raw(spark, sf).drop("y", "event_ts")


_OUTPUT = ("src_key", "customer_id", "predicted_conversion_prob", "is_recommended_call", "priority_tier", "telesales_action")


@query("sc_batch_score")
def sc_batch_score(spark, sf):
    model = trained(spark, sf, "post_call", train.TREES)
    return lakehouse.batch_score(_new_leads(spark, sf), model).select(*_OUTPUT)


@query("sc_route_scores")
def sc_route_scores(spark, sf):
    return lakehouse.score_leads(_new_leads(spark, sf), trained_modes(spark, sf, train.LOGISTIC)).select("mode", *_OUTPUT)


@query("sc_score_file")
def sc_score_file(spark, sf):
    source, target = shared_dir(spark, "leads"), f"{shared_dir(spark, 'scored')}.parquet"
    sinks.write_csv(_new_leads(spark, sf).select(*[f.name for f in LEADS if f.name != "y"], F.lit(None).cast("string").alias("y"))
                    .select(*[f.name for f in LEADS]), source)
    lakehouse.score_file(spark, source, target, trained(spark, sf, "post_call", train.LOGISTIC))
    return spark.read.parquet(target).select(*_OUTPUT)


@query("pipe_full")
def pipe_full(spark, sf):
    layers = lakehouse.Layers(shared_dir(spark, "full"))
    scored = lakehouse.run_full(fx.leads_dup(spark, sf), _new_leads(spark, sf), layers, "batch-1", train.LOGISTIC, ORDER)
    return scored.select(*_OUTPUT)


@query("pipe_daily")
def pipe_daily(spark, sf):
    layers = lakehouse.Layers(shared_dir(spark, "daily"))
    return lakehouse.run_daily(fx.leads_dup(spark, sf), layers, "batch-1", "test-only-salt", train.LOGISTIC, ORDER)
