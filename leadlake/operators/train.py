"""Conversion models on pyspark.ml: encoding, logistic regression, boosted trees, threshold, evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool

import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.config import DEFAULT, Settings
from leadlake.functions.encode import target_flag
from leadlake.operators.boost import fit_trees
from leadlake.operators.evaluate import best_thresholds, evaluate, threshold_curve
from leadlake.operators.forest import forest, indexed
from leadlake.operators.prep import Scaler, add_class_weight, assign_split, class_weights, model_columns, smote_points

LOGISTIC, TREES = "logistic_regression", "gradient_boosting"


@dataclass(frozen=True)
class TrainedModel:
    """A fitted pipeline with what scoring and explaining need besides it."""

    model: PipelineModel
    model_type: str
    mode: str
    feature_names: list[str]
    background: list[float]
    threshold: float = 0.5
    metrics: dict | None = None
    threshold_info: dict | None = None

    @property
    def classifier(self):
        return self.model.stages[-1]


def _scale_statement(scaler: Scaler) -> str:
    parts = [
        f"(CAST(`{c}` AS DOUBLE) - CAST({scaler.mean[c]!r} AS DOUBLE)) / CAST({scaler.std[c]!r} AS DOUBLE) AS `z_{c}`"
        for c in scaler.mean
    ]
    return f"SELECT *, {', '.join(parts)} FROM __THIS__"


def encoding_stages(train: DataFrame, mode: str, settings: Settings = DEFAULT) -> list:
    """Stages that scale (population deviation), one-hot encode (unseen level: all zeros) and assemble."""
    numeric, categorical = model_columns(mode, settings.features)
    scaler = Scaler.fit(train, numeric)
    as_text = ", ".join(f"CAST(`{c}` AS STRING) AS `t_{c}`" for c in categorical)
    return [
        SQLTransformer(statement=_scale_statement(scaler)),
        SQLTransformer(statement=f"SELECT *, {as_text} FROM __THIS__"),
        StringIndexer(inputCols=[f"t_{c}" for c in categorical], outputCols=[f"i_{c}" for c in categorical],
                      stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"i_{c}" for c in categorical], outputCols=[f"o_{c}" for c in categorical],
                      dropLast=True),
        VectorAssembler(inputCols=[f"z_{c}" for c in numeric] + [f"o_{c}" for c in categorical],
                        outputCol="features"),
    ]


def feature_names(encoder: PipelineModel, mode: str, settings: Settings = DEFAULT) -> list[str]:
    numeric, categorical = model_columns(mode, settings.features)
    indexer = next(s for s in encoder.stages if hasattr(s, "labelsArray"))
    blocks = [f"{c}_{level}" for c, levels in zip(categorical, indexer.labelsArray) for level in levels]
    return [*numeric, *blocks]


def classifier(model_type: str, weight_sum: float, settings: Settings = DEFAULT):
    t = settings.training
    if model_type == LOGISTIC:
        return LogisticRegression(
            featuresCol="features", labelCol="label", weightCol="weight", elasticNetParam=0.0,
            regParam=1.0 / (t.lr_c * weight_sum), standardization=False, maxIter=t.lr_max_iter,
        )
    if model_type == TREES:
        return GBTClassifier(
            featuresCol="features", labelCol="label", weightCol="weight", maxIter=t.gbt_trees,
            stepSize=t.gbt_step, maxDepth=t.gbt_depth, seed=t.seed,
        )
    raise ValueError(f"unsupported model type {model_type!r}")


def labelled(features: DataFrame) -> DataFrame:
    return features.withColumn("label", F.coalesce(target_flag(F.col("y")), F.lit(0)))


def add_probability(model: PipelineModel, df: DataFrame, name: str = "probability_yes") -> DataFrame:
    """Input columns plus the probability of a yes. Trees are asked batch by batch, from the columns before the assembler."""
    known = forest(df.sparkSession, model)
    if known is not None:
        shared = df.sparkSession.sparkContext.broadcast(known)

        @F.pandas_udf("double")
        def raw(*columns: pd.Series) -> pd.Series:
            return pd.Series(shared.value.raw(shared.value.features(columns)))

        odds = F.exp(-2.0 * raw(*[F.col(c) for c, _ in known.inputs]))
        return indexed(model, df).select(*df.columns, (1.0 / (1.0 + odds)).alias(name))
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))


def fit_model(train: DataFrame, mode: str, model_type: str, settings: Settings = DEFAULT) -> TrainedModel:
    """Fit on labelled rows. The encoder only sees these rows, so nothing leaks from the other parts."""
    numeric, categorical = model_columns(mode, settings.features)
    rows = train.select("label", *numeric, *categorical).persist()  # read for weights, scales, levels and the encoding
    try:
        weighted = add_class_weight(rows, "label")
        encoder = Pipeline(stages=encoding_stages(weighted, mode, settings)).fit(weighted)
        encoded = encoder.transform(weighted).select("features", "label", "weight").persist()
        try:
            facts = encoded.agg(F.sum("weight").alias("w"), Summarizer.mean(F.col("features")).alias("m")).first()
            rows.unpersist()
            weight_sum, means = facts.w, facts.m
            estimator = classifier(model_type, weight_sum, settings)
            if model_type == TREES:
                levels = next(s for s in encoder.stages if hasattr(s, "labelsArray")).labelsArray
                fitted = fit_trees(encoded, len(numeric), [len(v) for v in levels], estimator)
            else:
                fitted = estimator.fit(encoded)
        finally:
            encoded.unpersist()
    finally:
        rows.unpersist()
    return TrainedModel(
        PipelineModel(stages=[*encoder.stages, fitted]), model_type, mode,
        feature_names(encoder, mode, settings), [float(v) for v in means],
    )


def fit_oversampled(train: DataFrame, mode: str, key: str, model_type: str = LOGISTIC, settings: Settings = DEFAULT) -> TrainedModel:
    """Fit without weights on classes made equal by synthetic rows between encoded neighbours, as an alternative to weighting.

    Only training rows are encoded and oversampled; ``key`` is unique in them.
    """
    encoder = Pipeline(stages=encoding_stages(train, mode, settings)).fit(train)
    names = feature_names(encoder, mode, settings)
    points = encoder.transform(train).select(key, "label", vector_to_array("features").alias("x"))
    balanced = smote_points(points, "x", "label", key, cell_rows=512)  # in many dimensions small cells leave fewer pairs
    rows = balanced.select(array_to_vector("x").alias("features"), "label", F.lit(1.0).alias("weight")).persist()
    try:
        facts = rows.agg(F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("features")).alias("m")).first()
        fitted = classifier(model_type, float(facts.n), settings).fit(rows)
    finally:
        rows.unpersist()
    return TrainedModel(PipelineModel(stages=[*encoder.stages, fitted]), model_type, mode, names, [float(v) for v in facts.m])


def train_model(features: DataFrame, mode: str, model_type: str = TREES, settings: Settings = DEFAULT) -> TrainedModel:
    """Split by customer, fit on train, choose the threshold on validation, measure on test."""
    parts = assign_split(labelled(features), "customer_id", settings.split)
    trained = fit_model(parts.filter("split = 'train'"), mode, model_type, settings)
    held = add_probability(trained.model, parts.filter("split <> 'train'"))
    held = held.select("split", "label", F.col("probability_yes").alias("score")).persist()  # scored once, read three times
    try:
        curve = threshold_curve(held.filter("split = 'validation'"), money=settings.economics)
        info = best_thresholds(curve, settings.training.threshold_metric).first().asDict()
        metrics = evaluate(held.filter("split = 'test'"), info["optimal_threshold"]).first().asDict()
    finally:
        held.unpersist()
    return replace(trained, threshold=info["optimal_threshold"], metrics=metrics, threshold_info=info)


def train_models(features: DataFrame, modes: Sequence[str], model_type: str = TREES, settings: Settings = DEFAULT) -> dict[str, TrainedModel]:
    """One model per mode, fitted side by side: a fit is hundreds of short jobs, and each fills the gaps of the other."""
    if not modes:
        return {}
    fits = [inheritable_thread_target(features.sparkSession)(lambda m=m: train_model(features, m, model_type, settings)) for m in modes]
    with ThreadPool(len(fits)) as pool:
        return dict(zip(modes, pool.map(lambda fit: fit(), fits)))


def coefficients(trained: TrainedModel) -> list[tuple[str, float]]:
    """(feature, weight) of a linear model, largest first."""
    if trained.model_type != LOGISTIC:
        raise ValueError("only a linear model has coefficients")
    pairs = zip(trained.feature_names, [float(v) for v in trained.classifier.coefficients])
    return sorted(pairs, key=lambda p: (-p[1], p[0]))


__all__ = [
    "LOGISTIC", "TREES", "TrainedModel", "add_probability", "class_weights", "classifier", "coefficients",
    "encoding_stages", "feature_names", "fit_model", "fit_oversampled", "labelled", "train_model", "train_models",
]
