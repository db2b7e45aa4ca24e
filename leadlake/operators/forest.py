"""Scores of a boosted ensemble by Arrow batches: what the encoder's last stages and the trees do, for all rows of a batch at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import OneHotEncoderModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession

from leadlake.session import shared_dir

MAX_TREE_NODES = 2_000_000


def tree_nodes(spark: SparkSession, model) -> dict[int, dict[int, tuple]]:
    """Nodes of every tree, read back from the saved form of the classifier:
    {tree: {id: (prediction, cover, left, right, feature, low interval of the left child)}}."""
    path = shared_dir(spark, "trees")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    trees: dict[int, dict[int, tuple]] = {}
    for r in rows:
        low = None
        if r.leftChild >= 0:
            at = r.split.leftCategoriesOrThreshold
            if r.split.numCategories < 0:
                low = (-np.inf, at[0])
            elif r.split.numCategories == 2 and len(at) == 1:  # a 0/1 input: the left side holds one of the two
                low = (-np.inf, 0.5) if at[0] == 0.0 else (0.5, np.inf)
            else:
                raise ValueError("only numeric and 0/1 inputs can be attributed")
        trees.setdefault(r.treeID, {})[r.id] = (
            r.prediction, r.impurityStats[0], r.leftChild, r.rightChild, r.split.featureIndex, low)
    return trees


@dataclass(frozen=True)
class Forest:
    """Trees with their weights, and how the columns of an encoded row make up its features: (column, number of 0/1 features, or 0
    for a number)."""

    trees: list[dict[int, tuple]]
    weights: list[float]
    inputs: list[tuple[str, int]]

    def features(self, columns: Sequence[pd.Series]) -> np.ndarray:
        """Features of all rows. A category's index beyond its levels leaves all its features at 0."""
        n = len(columns[0]) if columns else 0
        out, at = np.zeros((n, sum(max(size, 1) if size >= 0 else 0 for _, size in self.inputs))), 0
        for (name, size), values in zip(self.inputs, columns):
            given = values.to_numpy(float)
            if np.isnan(given).any():  # as the assembler does
                raise ValueError(f"{name} is missing in a row that is to be scored")
            if size == 0:
                out[:, at] = given
                at += 1
            elif size > 0:
                level = given.astype(np.intp)
                held = np.flatnonzero(level < size)
                out[held, at + level[held]] = 1.0
                at += size
        return out

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Weighted sum of the trees, half the log-odds."""
        columns, known = np.ascontiguousarray(x.T), {}

        def left(feature: int, low: tuple[float, float]) -> np.ndarray:
            if (feature, low) not in known:
                known[feature, low] = columns[feature] <= low[1] if low[0] == -np.inf else columns[feature] > low[0]
            return known[feature, low]

        def value(nodes: dict[int, tuple], i: int):
            prediction, _, a, b, feature, low = nodes[i]
            return prediction if a < 0 else np.where(left(feature, low), value(nodes, a), value(nodes, b))

        total = np.zeros(len(x))
        for nodes, weight in zip(self.trees, self.weights):
            total += weight * value(nodes, 0)
        return total


def forest(spark: SparkSession, model: PipelineModel) -> Forest | None:
    """The ensemble of a fitted pipeline; None if it ends in something else. Read once per model; its size is checked first."""
    classifier = model.stages[-1]
    if not isinstance(classifier, GBTClassificationModel):
        return None
    if classifier.totalNumNodes > MAX_TREE_NODES:
        raise ValueError(f"{classifier.totalNumNodes} tree nodes are too many to ship to every task")
    if "_forest" not in classifier.__dict__:
        encoder, assembler = model.stages[-3:-1]
        if not (isinstance(encoder, OneHotEncoderModel) and isinstance(assembler, VectorAssembler)):
            raise ValueError("the ensemble does not stand behind a one-hot encoder and an assembler")
        sizes = [n - encoder.getDropLast() for n in encoder.categorySizes]
        coded = {out: (index, size or -1) for out, index, size in zip(encoder.getOutputCols(), encoder.getInputCols(), sizes)}
        nodes = tree_nodes(spark, classifier)
        classifier.__dict__["_forest"] = Forest(
            [nodes[t] for t in sorted(nodes)], list(classifier.treeWeights), [coded.get(c, (c, 0)) for c in assembler.getInputCols()])
    return classifier.__dict__["_forest"]


def indexed(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the columns that ``Forest.features`` reads: scaled numbers and indexes of levels."""
    return PipelineModel(stages=model.stages[:-3]).transform(df)
