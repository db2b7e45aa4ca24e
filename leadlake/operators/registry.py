"""Saved models: one folder per version, a metadata row, and a pointer to the active version written last."""

from __future__ import annotations

import json
import time
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from leadlake.operators.train import TrainedModel

_ROW = "version string, saved_at double, body string"


def _folder(root: str, mode: str) -> str:
    return f"{root.rstrip('/')}/{mode}"


def save_model(spark: SparkSession, trained: TrainedModel, root: str, version: str | None = None,
               importance: list | None = None) -> str:
    """Model, then metadata, then the pointer: a reader never sees a version that is half written."""
    version = version or f"v{int(time.time() * 1000)}"
    base = f"{_folder(root, trained.mode)}/version={version}"
    trained.model.write().overwrite().save(f"{base}/model")
    body = {k: v for k, v in asdict(_without_model(trained)).items() if k != "model"}
    body["global_importance"] = importance or []
    row = spark.createDataFrame([(version, time.time(), json.dumps(body))], _ROW)
    row.write.mode("overwrite").parquet(f"{base}/metadata")
    row.write.mode("append").parquet(f"{_folder(root, trained.mode)}/active")
    return base


def _without_model(trained: TrainedModel) -> TrainedModel:
    from dataclasses import replace

    return replace(trained, model=None)


def _active(spark: SparkSession, root: str, mode: str):
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.schema(_ROW).parquet(f"{_folder(root, mode)}/active")
        return rows.orderBy(rows.saved_at.desc(), rows.version.desc()).first()
    except AnalysisException:
        return None


def is_model_available(spark: SparkSession, root: str, mode: str) -> bool:
    return _active(spark, root, mode) is not None


def load_active_model(spark: SparkSession, root: str, mode: str) -> TrainedModel:
    row = _active(spark, root, mode)
    if row is None:
        raise FileNotFoundError(f"no saved model for mode {mode!r}")
    body = json.loads(row.body)
    model = PipelineModel.load(f"{_folder(root, mode)}/version={row.version}/model")
    return TrainedModel(
        model, body["model_type"], body["mode"], body["feature_names"], body["background"],
        body["threshold"], body["metrics"], body["threshold_info"],
    )


def registry_table(spark: SparkSession, root: str, mode: str):
    """(version, saved_at, body) of every saved version."""
    return spark.read.schema(_ROW).parquet(f"{_folder(root, mode)}/active")
