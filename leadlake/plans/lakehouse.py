"""Runs over the table layers: raw batch, Bronze, Silver, Gold, models, scored leads.

Each table is written once per run, by one job. A checked table keeps its good and its bad rows as two
partitions of one folder, so a single pass over the input feeds both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.config import DEFAULT, Settings
from leadlake.functions.features import derive_leads
from leadlake.functions.text import normalise_names
from leadlake.operators import conform, contracts, marts
from leadlake.operators.explain import explained, global_importance, linear_attributions, tree_attributions
from leadlake.operators.fairness import audit
from leadlake.operators.privacy import deidentify
from leadlake.operators.registry import is_model_available, load_active_model, save_model
from leadlake.operators.score import add_decision, dialer_queue, route_mode
from leadlake.operators.train import (
    LOGISTIC, TREES, TrainedModel, add_probability, labelled, train_model, train_models,
)
from leadlake.operators.prep import assign_split
from leadlake.schemas import LEADS, as_text
from leadlake.sources.readers import read_batch_file
from leadlake.sources.sinks import batch_folder, overwrite_table, write_by_suffix

SIDE, VALID, BAD = "_side", "valid", "quarantine"


@dataclass(frozen=True)
class Layers:
    """Folders of one lake."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def bronze(self) -> str:
        return self.path("bronze/telemarketing")

    @property
    def dim(self) -> str:
        return self.path("silver/dim_customer")

    @property
    def fact(self) -> str:
        return self.path("silver/fact_campaign_interaction")

    @property
    def campaign_mart(self) -> str:
        return self.path("gold/mart_campaign_performance")

    @property
    def segment_mart(self) -> str:
        return self.path("gold/mart_customer_segment_conversion")

    @property
    def features(self) -> str:
        return self.path("gold/feature_table")

    @property
    def models(self) -> str:
        return self.path("models")


def read_side(spark: SparkSession, path: str, side: str = VALID, merge: bool = False) -> DataFrame:
    """Good rows (or the quarantine) of a checked table; the other partition is not read. ``merge`` is for
    Bronze, whose batches may differ in their optional columns."""
    df = spark.read.option("mergeSchema", merge).parquet(path).filter(F.col(SIDE) == side).drop(SIDE)
    return df.drop(contracts.REASON) if side == VALID else df


def _written_counts(df: DataFrame) -> dict[str, int]:
    """Rows per side of a written table. Only partition values are asked for, so no column is read."""
    return {r[SIDE]: r["n"] for r in df.groupBy(SIDE).agg(F.count(F.lit(1)).alias("n")).collect()}


def _sided(checked: DataFrame) -> DataFrame:
    return checked.withColumn(SIDE, F.when(F.col(contracts.REASON) == "", VALID).otherwise(BAD))


def cast_contract(df: DataFrame) -> DataFrame:
    """Contract types; text that does not parse becomes NULL and is caught by the rules beforehand."""
    kinds = {f.name: f.dataType.simpleString() for f in LEADS if f.dataType.simpleString() in ("int", "double")}
    return df.withColumns({c: F.col(c).try_cast(k) for c, k in kinds.items() if c in df.columns})


def checked_batch(df: DataFrame, batch_id: str, settings: Settings = DEFAULT, source: str | Column = "frame") -> DataFrame:
    """A raw batch with its side, reasons, contract types and audit columns. The ratio gate may refuse it."""
    named = normalise_names(df)
    contracts.require_columns(named)
    rules = contracts.bronze_rules(settings.contracts)
    if settings.contracts.enforce_ratio:
        gate = contracts.quarantine_ratio(named, rules, settings.contracts).first()
        contracts.enforce_ratio(gate.total_rows, gate.quarantined_rows, settings.contracts)
    return conform.add_audit(cast_contract(_sided(contracts.check(named, rules))), batch_id, source)


def ingest_frame(df: DataFrame, layers: Layers, batch_id: str, settings: Settings = DEFAULT,
                 source: str | Column = "frame") -> dict:
    """Check one raw batch and add it to Bronze. Writing a batch id again replaces that batch."""
    named, rules = normalise_names(df), contracts.bronze_rules(settings.contracts)
    audited = checked_batch(df, batch_id, settings, source)
    written = audited if settings.contracts.write_quarantine else audited.filter(F.col(SIDE) == VALID)
    folder = batch_folder(layers.bronze, batch_id)
    # One folder per batch, its sides below it: a batch that comes again replaces both sides, whatever it brings now.
    (
        written.drop("_batch_id").write.mode("overwrite").option("partitionOverwriteMode", "static")
        .option("compression", "snappy").partitionBy(SIDE).parquet(folder)
    )
    if settings.contracts.write_quarantine:
        sided = written.schema[SIDE]
        batch = df.sparkSession.read.schema(T.StructType([sided])).parquet(folder)
    else:
        batch = _sided(contracts.check(named, rules))  # the bad rows are still counted, though not kept
    sides = _written_counts(batch)
    return {"batch_id": batch_id, "ingested_records": sides.get(VALID, 0), "quarantined_records": sides.get(BAD, 0)}


def ingest_file(spark: SparkSession, path: str, layers: Layers, batch_id: str, settings: Settings = DEFAULT) -> dict:
    """A delivered file. CSV is read as text, so that a bad cell quarantines its row and not the batch."""
    raw = read_batch_file(spark, path, as_text(LEADS))
    return ingest_frame(raw, layers, batch_id, settings, conform.file_name())


def _write_checked(df: DataFrame, rules, path: str) -> int:
    _sided(contracts.check(df, rules)).write.mode("overwrite").option("compression", "snappy").partitionBy(SIDE).parquet(path)
    return _written_counts(df.sparkSession.read.parquet(path)).get(VALID, 0)


def build_silver(spark: SparkSession, layers: Layers, order=conform.AUDIT_ORDER, settings: Settings = DEFAULT) -> dict:
    """Dimension and fact from all Bronze batches. Rows that break a Silver contract go to its quarantine side."""
    bronze = read_side(spark, layers.bronze, merge=True)
    if bronze.isEmpty():
        raise ValueError("Bronze holds no valid rows")
    stamp = F.current_timestamp()
    dim = conform.build_dim_customer(bronze, order).withColumn("_processed_at", stamp)
    fact = conform.build_fact_interaction(bronze, order).withColumn("_processed_at", stamp)
    # Both keys are unique by construction: they are the grouping keys of the aggregates above.
    out = {
        "dim_customer_count": _write_checked(dim, contracts.customer_rules(settings.contracts), layers.dim),
        "fact_interaction_count": _write_checked(fact, contracts.interaction_rules(), layers.fact),
    }
    read_side(spark, layers.dim).createOrReplaceTempView("dim_customer")
    read_side(spark, layers.fact).createOrReplaceTempView("fact_campaign_interaction")
    return out


def build_gold(spark: SparkSession, layers: Layers) -> None:
    dim = read_side(spark, layers.dim).drop("_processed_at")
    fact = read_side(spark, layers.fact).drop("_processed_at")
    tables = {
        layers.campaign_mart: marts.campaign_performance(fact),
        layers.segment_mart: marts.segment_conversion(dim, fact),
        layers.features: marts.feature_table(dim, fact, ("interaction_id",)),
    }
    for path, df in tables.items():
        overwrite_table(df, path)
        spark.read.parquet(path).createOrReplaceTempView(path.rsplit("/", 1)[-1])


def offline_features(spark: SparkSession, layers: Layers) -> DataFrame:
    """The feature table, built first when a run has not done so."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(layers.features)
    except AnalysisException:
        build_gold(spark, layers)
        return spark.read.parquet(layers.features)


def run_lakehouse(raw: DataFrame, layers: Layers, batch_id: str, order=conform.AUDIT_ORDER,
                  settings: Settings = DEFAULT) -> DataFrame:
    """Ingest, Silver, marts, features. Returns (layer, n) read back from the written tables."""
    spark = raw.sparkSession
    ingest_frame(raw, layers, batch_id, settings)
    build_silver(spark, layers, order, settings)
    build_gold(spark, layers)
    return layer_counts(spark, layers)


def layer_counts(spark: SparkSession, layers: Layers) -> DataFrame:
    from leadlake.operators.profile import named_counts

    return named_counts({
        "bronze": read_side(spark, layers.bronze),
        "quarantine": read_side(spark, layers.bronze, BAD),
        "dim_customer": read_side(spark, layers.dim),
        "fact_campaign_interaction": read_side(spark, layers.fact),
        "mart_campaign_performance": spark.read.parquet(layers.campaign_mart),
        "mart_customer_segment_conversion": spark.read.parquet(layers.segment_mart),
        "feature_table": spark.read.parquet(layers.features),
    })


def attributions(trained: TrainedModel, df: DataFrame, key: str) -> DataFrame:
    if trained.model_type == LOGISTIC:
        return linear_attributions(trained, df).select(key, "attributions", "base_margin", "margin")
    return tree_attributions(trained, df, key)


def train_and_save(features: DataFrame, layers: Layers, mode: str, model_type: str = TREES,
                   settings: Settings = DEFAULT, explain: bool = True, version: str | None = None) -> TrainedModel:
    """Train one mode and register it, with the global importance over its training rows."""
    return _save(features, layers, train_model(features, mode, model_type, settings), settings, explain, version)


def _save(features: DataFrame, layers: Layers, trained: TrainedModel, settings: Settings, explain: bool,
          version: str | None = None) -> TrainedModel:
    importance = []
    if explain:
        train = assign_split(labelled(features), "customer_id", settings.split).filter("split = 'train'")
        ranked = global_importance(attributions(trained, train, "customer_id"), trained.feature_names, 8)
        importance = [r.asDict() for r in ranked.collect()]
    save_model(features.sparkSession, trained, layers.models, version, importance)
    return trained


def train_modes(features: DataFrame, layers: Layers, model_type: str = TREES, settings: Settings = DEFAULT,
                explain: bool = True) -> dict[str, TrainedModel]:
    """Both modes, fitted side by side and registered one after the other."""
    models = train_models(features, MODES, model_type, settings)
    return {m: _save(features, layers, trained, settings, explain) for m, trained in models.items()}


def load_models(spark: SparkSession, layers: Layers) -> dict[str, TrainedModel]:
    return {m: load_active_model(spark, layers.models, m) for m in ("pre_call", "post_call")
            if is_model_available(spark, layers.models, m)}


MODES = ("pre_call", "post_call")


def _with_probability(trained: TrainedModel, leads: DataFrame, explain: bool) -> DataFrame:
    return explained(trained, leads) if explain else add_probability(trained.model, leads)


def score_leads(leads: DataFrame, models: dict[str, TrainedModel], settings: Settings = DEFAULT, mode: str = "auto",
                explain: bool = False) -> DataFrame:
    """Derive, route by mode, score each part with its model, decide. Works on batches and on streams. ``explain`` adds what
    drove each score to its row.

    ``mode`` may force one mode for all leads. A mode that leads can be routed to must have a model: otherwise nothing is
    scored, so that no lead is lost.
    """
    if mode not in ("auto", *MODES):
        raise ValueError(f"unknown mode {mode!r}")
    needed = MODES if mode == "auto" else (mode,)
    missing = [m for m in needed if m not in models]
    if missing:
        raise ValueError(f"no model for {', '.join(missing)}")
    derived = derive_leads(leads)
    routed = route_mode(derived) if mode == "auto" else derived.withColumn("mode", F.lit(mode))
    parts = []
    for mode, trained in ((m, models[m]) for m in needed):
        part = _with_probability(trained, routed.filter(F.col("mode") == mode), explain)
        parts.append(add_decision(part, "probability_yes", trained.threshold, settings.tiers))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def batch_score(leads: DataFrame, trained: TrainedModel, settings: Settings = DEFAULT, explain: bool = False) -> DataFrame:
    """Score all leads with one model and put the best first."""
    scored = _with_probability(trained, derive_leads(leads), explain)
    decided = add_decision(scored, "probability_yes", trained.threshold, settings.tiers)
    return dialer_queue(decided, "predicted_conversion_prob", "customer_id")


def score_file(spark: SparkSession, source: str, target: str, trained: TrainedModel,
               settings: Settings = DEFAULT, explain: bool = False) -> None:
    """Leads of a file, scored into a file; drivers are written as JSON texts, which CSV can hold as well."""
    scored = batch_score(read_batch_file(spark, source, LEADS), trained, settings, explain)
    if explain:
        scored = scored.drop("attributions").withColumns({c: F.to_json(c) for c in ("positive_drivers", "negative_drivers")})
    write_by_suffix(scored, target)


def run_full(raw: DataFrame, leads: DataFrame, layers: Layers, batch_id: str, model_type: str = TREES,
             order=conform.AUDIT_ORDER, settings: Settings = DEFAULT) -> DataFrame:
    """Lakehouse run, training of both modes, scoring of new leads. Returns the scored leads."""
    spark = raw.sparkSession
    run_lakehouse(raw, layers, batch_id, order, settings)
    train_modes(spark.read.parquet(layers.features), layers, model_type, settings)
    models = load_models(spark, layers)
    target = layers.path("gold/scored_leads")
    overwrite_table(batch_score(leads, models["post_call"], settings), target)
    return spark.read.parquet(target)


def run_daily(raw: DataFrame, layers: Layers, batch_id: str, salt: str, model_type: str = TREES,
              order=conform.AUDIT_ORDER, settings: Settings = DEFAULT) -> DataFrame:
    """Daily run: layers, de-identified dimension, both models, fairness by age. One summary row per mode."""
    spark = raw.sparkSession
    ingested = ingest_frame(raw, layers, batch_id, settings)
    silver = build_silver(spark, layers, order, settings)
    masked = layers.path("gold/dim_customer_deidentified")
    overwrite_table(deidentify(read_side(spark, layers.dim), salt, mask_financials=True), masked)
    build_gold(spark, layers)
    features = spark.read.parquet(layers.features)
    test = assign_split(labelled(features), "customer_id", settings.split).filter("split = 'test'")
    rows = None
    for mode, trained in train_modes(features, layers, model_type, settings, explain=False).items():
        decided = add_probability(trained.model, test).withColumn(
            "decision", (F.col("probability_yes") >= F.lit(trained.threshold)).cast("int"))
        line = audit(decided, ["age"], "label", "decision").select(
            F.lit("SUCCESS").alias("status"), F.lit(mode).alias("mode"),
            F.lit(ingested["ingested_records"]).cast("long").alias("ingested_records"),
            F.lit(silver["dim_customer_count"]).cast("long").alias("silver_customers"),
            F.lit(silver["fact_interaction_count"]).cast("long").alias("silver_interactions"),
            F.lit(float(trained.threshold)).alias("threshold"),
            F.lit(trained.metrics["roc_auc"]).cast("double").alias("roc_auc"),
            F.lit(trained.metrics["pr_auc"]).cast("double").alias("pr_auc"),
            "disparate_impact_ratio", "equal_opportunity_difference", F.col("status").alias("fairness_status"),
        )
        rows = line if rows is None else rows.unionByName(line)
    tokens = spark.read.parquet(masked).agg(F.count(F.lit(1))).scalar()
    n_features = features.agg(F.count(F.lit(1))).scalar()
    return rows.withColumns({"deidentified_tokens": tokens, "feature_records": n_features})
