"""Attribution of scores to features.

Linear models: weight times distance from the training mean, as column expressions. Trees: the
path-dependent Shapley values of each tree (Lundberg et al., 2020), looked up per Arrow batch in tables made once per model.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.operators.forest import Forest, forest, indexed
from leadlake.operators.forest import tree_nodes as _tree_nodes
from leadlake.operators.train import LOGISTIC, TrainedModel

#: Splits of one group of leaves; its tables have two to that power entries.
_GROUP_BITS = 9


def linear_attributions(trained: TrainedModel, df: DataFrame, name: str = "attributions") -> DataFrame:
    """Adds an array with w_i * (x_i - mean_i), whose sum plus ``base_margin`` is the model's margin."""
    if trained.model_type != LOGISTIC:
        raise ValueError("linear attribution needs a linear model")
    weights = [float(w) for w in trained.classifier.coefficients]
    base = float(trained.classifier.intercept) + float(np.dot(weights, trained.background))
    encoded = trained.model.transform(df)
    pairs = F.arrays_zip(
        F.array(*[F.lit(w) for w in weights]).alias("w"), F.array(*[F.lit(m) for m in trained.background]).alias("m")
    )
    values = F.zip_with(vector_to_array("features"), pairs, lambda x, p: p["w"] * (x - p["m"]))
    return encoded.select(
        *df.columns, values.alias(name), F.lit(base).alias("base_margin"),
        vector_to_array("rawPrediction")[1].alias("margin"),
    )


# --- Trees ----------------------------------------------------------------------

def _tree_paths(trees: dict[int, dict[int, tuple]], weights: Sequence[float]) -> list[tuple]:
    """One entry per leaf: (tree weight * leaf value, [(feature, cover share, lower, upper)...]).

    A feature met twice on the way down is merged: the shares multiply and the intervals intersect.
    """
    paths = []
    for tree, weight in enumerate(weights):
        nodes = trees[tree]
        stack = [(0, {})]
        while stack:
            here, seen = stack.pop()
            prediction, cover, left, right, feature, low = nodes[here]
            if left < 0:
                paths.append((weight * prediction, [(f, *v) for f, v in seen.items()]))
                continue
            high = (low[1], np.inf) if low[0] == -np.inf else (-np.inf, low[0])
            for child, (a, b) in ((left, low), (right, high)):
                share, lo, hi = seen.get(feature, (1.0, -np.inf, np.inf))
                part = nodes[child][1] / cover
                stack.append((child, {**seen, feature: (share * part, max(lo, a), min(hi, b))}))
    return paths


def _subset_weights(size: int) -> np.ndarray:
    """Shapley weight of a coalition of s others out of ``size`` players, s = 0..size-1."""
    return np.array([factorial(s) * factorial(size - s - 1) / factorial(size) for s in range(size)])


def _leaf_values(ones: np.ndarray, shares: Sequence[float]) -> np.ndarray:
    """Shapley value of each condition of a leaf worth 1, by condition and case. The weighted coalition sums are coefficients of
    prod_j (share_j + one_j * t) over the other conditions of the path."""
    size, cases = ones.shape
    weight, out = _subset_weights(size), np.empty(ones.shape)
    for i in range(size):
        poly = np.zeros((size, cases))
        poly[0] = 1.0
        for j in range(size):
            if j != i:
                shifted = np.vstack([np.zeros((1, cases)), poly[:-1]])
                poly = poly * shares[j] + shifted * ones[j]
        out[i] = (ones[i] - shares[i]) * (weight @ poly)
    return out


def _tree_shap(x: np.ndarray, paths: list[tuple]) -> np.ndarray:
    """Shapley values of all rows at once, leaf by leaf."""
    phi = np.zeros(x.shape)
    for value, conditions in paths:
        if conditions:
            ones = np.stack([((x[:, f] > lo) & (x[:, f] <= hi)).astype(float) for f, _, lo, hi in conditions])
            for (feature, *_), worth in zip(conditions, _leaf_values(ones, [c[1] for c in conditions])):
                phi[:, feature] += value * worth
    return phi


@dataclass(frozen=True)
class LeafTables:
    """Shapley values of groups of leaves by how a row meets their thresholds.

    ``splits`` are the distinct (feature, threshold) of all groups. A group names its splits, at most ``_GROUP_BITS``; whether a
    row is at or below each of them, read as a number, is the entry of the row in one table per feature. Leaves
    with more splits than that are kept as paths.
    """

    splits: list[tuple[int, float]]
    groups: list[tuple[list[int], list[tuple[int, np.ndarray]]]]
    paths: list[tuple]


def _group_table(leaves: list[tuple], at: dict[tuple[int, float], int]) -> list[tuple[int, np.ndarray]]:
    """(feature, value by pattern) of some leaves; ``at`` gives the place of each split, the first being the highest bit."""
    patterns = np.arange(1 << len(at))
    below = {split: (patterns >> (len(at) - 1 - place)) & 1 == 1 for split, place in at.items()}
    tables: dict[int, np.ndarray] = {}
    for value, conditions in leaves:
        ones = np.stack([below.get((f, hi), True) & ~below.get((f, lo), np.zeros(len(patterns), bool)) for f, _, lo, hi in conditions])
        for (feature, *_), worth in zip(conditions, _leaf_values(ones.astype(float), [c[1] for c in conditions])):
            tables[feature] = tables.get(feature, 0.0) + value * worth
    return list(tables.items())


def leaf_tables(paths: list[tuple]) -> LeafTables:
    """Neighbouring leaves share most of their splits and go into one group until it is full."""
    known: dict[tuple[int, float], int] = {}
    groups, single = [], []
    leaves: list[tuple] = []
    at: dict[tuple[int, float], int] = {}

    def close() -> None:
        if leaves:
            groups.append(([known.setdefault(split, len(known)) for split in at], _group_table(leaves, at)))

    for path in paths:
        own = list(dict.fromkeys((f, b) for f, _, lo, hi in path[1] for b in (lo, hi) if np.isfinite(b)))
        if len(own) > _GROUP_BITS:
            single.append(path)
        elif path[1]:
            if len(at) + sum(split not in at for split in own) > _GROUP_BITS:
                close()
                leaves, at = [], {}
            for split in own:
                at.setdefault(split, len(at))
            leaves.append(path)
    close()
    return LeafTables(list(known), groups, single)


def _table_shap(x: np.ndarray, tables: LeafTables) -> np.ndarray:
    """The same values as ``_tree_shap``, looked up. Coordinates are finite, as the assembler refuses others."""
    columns = np.ascontiguousarray(x.T)
    below = np.empty((len(tables.splits), len(x)), np.uint16)
    for i, (feature, threshold) in enumerate(tables.splits):
        np.less_equal(columns[feature], threshold, out=below[i], casting="unsafe")
    phi, pattern = np.zeros(columns.shape), np.empty(len(x), np.uint16)
    for splits, by_feature in tables.groups:
        pattern[:] = 0
        for split in splits:
            np.left_shift(pattern, 1, out=pattern)
            np.bitwise_or(pattern, below[split], out=pattern)
        entry = pattern.astype(np.intp)
        for feature, values in by_feature:
            phi[feature] += values[entry]
    return phi.T + _tree_shap(x, tables.paths) if tables.paths else np.ascontiguousarray(phi.T)


def _leaf_table(trained: TrainedModel, spark: SparkSession) -> tuple[Forest, list[tuple], float]:
    """The ensemble, its leaf paths on the log-odds scale and the margin of an unknown row."""
    known = forest(spark, trained.model)
    if known is None:
        raise ValueError("tree attribution needs boosted trees")
    # The classifier's probability is 1 / (1 + exp(-2 * raw)), so log-odds are twice the raw sum.
    paths = [(2.0 * v, c) for v, c in _tree_paths(dict(enumerate(known.trees)), known.weights)]
    return known, paths, float(sum(v * np.prod([c[1] for c in conds]) if conds else v for v, conds in paths))


def tree_attributions(trained: TrainedModel, df: DataFrame, key: str, name: str = "attributions") -> DataFrame:
    """(key, attributions, base_margin, margin) on the log-odds scale: sum + base = margin.

    A saved ensemble is small (trees x nodes) and its size is checked; it travels to the tasks once, rows
    are never gathered.
    """
    known, paths, base = _leaf_table(trained, df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((known, leaf_tables(paths)))
    inputs = [f"_{i}" for i in range(len(known.inputs))]
    encoded = indexed(trained.model, df).select(F.col(key), *[F.col(c).alias(i) for i, (c, _) in zip(inputs, known.inputs)])
    key_type = encoded.schema[key].dataType.simpleString()

    def attribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ensemble, tables = shared.value
        for batch in batches:
            if len(batch):
                x = ensemble.features([batch[i] for i in inputs])
                yield pd.DataFrame({key: batch[key], name: list(_table_shap(x, tables)), "base_margin": base, "margin": 2.0 * ensemble.raw(x)})

    return encoded.mapInPandas(
        attribute, f"`{key}` {key_type}, `{name}` array<double>, base_margin double, margin double"
    )


def explained(trained: TrainedModel, df: DataFrame, probability: str = "probability_yes", k: int = 3) -> DataFrame:
    """Input columns, the probability of a yes and what drove it, row by row: ``attributions`` (log-odds, with ``base_margin``
    they add up to ``margin``), ``positive_drivers`` and ``negative_drivers``. Nothing is joined or gathered, so it works on
    streams as on batches; a linear model stays in expressions, trees see one Arrow column."""
    if trained.model_type == LOGISTIC:
        encoded, odds = trained.model.transform(df), vector_to_array("probability")
        weights = [float(w) for w in trained.classifier.coefficients]
        base = float(trained.classifier.intercept) + float(np.dot(weights, trained.background))
        pairs = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(m).alias("m")) for w, m in zip(weights, trained.background)])
        values = F.zip_with(vector_to_array("features"), pairs, lambda x, p: p["w"] * (x - p["m"]))
        rows = encoded.select(*df.columns, odds[1].alias(probability), values.alias("attributions"),
                              F.lit(base).alias("base_margin"), vector_to_array("rawPrediction")[1].alias("margin"))
    else:
        known, paths, base = _leaf_table(trained, df.sparkSession)
        shared = df.sparkSession.sparkContext.broadcast((known, leaf_tables(paths)))

        @F.pandas_udf("phi array<double>, margin double")
        def shapley(*columns: pd.Series) -> pd.DataFrame:
            ensemble, tables = shared.value
            x = ensemble.features(columns)
            return pd.DataFrame({"phi": pd.Series(list(_table_shap(x, tables)) if len(x) else [], dtype="object"), "margin": 2.0 * ensemble.raw(x)})

        told = indexed(trained.model, df).select(*df.columns, shapley(*[F.col(c) for c, _ in known.inputs]).alias("_told"))
        rows = told.select(*df.columns, (1.0 / (1.0 + F.exp(-F.col("_told.margin")))).alias(probability), F.col("_told.phi").alias("attributions"),
                           F.lit(base).alias("base_margin"), F.col("_told.margin").alias("margin"))
    return top_drivers(rows, trained.feature_names, k)


# --- Reports ----------------------------------------------------------------------

def top_drivers(df: DataFrame, names: Sequence[str], k: int = 3, column: str = "attributions") -> DataFrame:
    """Adds ``positive_drivers`` and ``negative_drivers``: up to k {feature, impact} structs each."""
    labels = F.array(*[F.lit(n) for n in names])
    # Rounding a double is dear. It keeps the order, so only what lies within a rounding step of the k-th can be among the first k.
    pairs = F.zip_with(labels, F.col(column), lambda n, v: F.struct(n.alias("feature"), v.alias("v")))
    ordered = F.sort_array(F.filter(column, lambda v: v.isNotNull()), asc=False)

    def strongest(sign: int) -> Column:
        kth = F.get("_ordered", F.lit(k - 1)) if sign > 0 else -F.get("_ordered", F.size("_ordered") - k)
        least = F.coalesce(kth, F.lit(float("-inf"))) - 2e-4
        near = F.filter("_pairs", lambda p: (p["v"] * sign > 0) & (p["v"] * sign >= least))
        # The struct sorts by strength first; names break ties.
        rounded = F.transform(near, lambda p: F.struct(
            (F.round(p["v"], 4) * -sign).alias("order"), p["feature"].alias("feature"), F.round(p["v"], 4).alias("impact")))
        kept = F.filter(rounded, lambda p: p["impact"] * sign > 0)
        return F.transform(F.slice(F.sort_array(kept), 1, k), lambda p: F.struct(p["feature"], p["impact"]))

    drivers = {"positive_drivers": strongest(1), "negative_drivers": strongest(-1)}
    return df.withColumns({"_pairs": pairs, "_ordered": ordered}).withColumns(drivers).drop("_pairs", "_ordered")


def global_importance(df: DataFrame, names: Sequence[str], n: int = 10, column: str = "attributions") -> DataFrame:
    """Mean absolute attribution per feature over all rows, the n largest.

    One wide aggregate: no row is multiplied by the number of features.
    """
    wide = df.agg(*[F.avg(F.abs(F.col(column)[i])).alias(f"m{i}") for i in range(len(names))])
    rows = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.round(F.col(f"m{i}"), 4).alias("importance")) for i, f in enumerate(names)
    ])
    listed = wide.select(F.explode(rows).alias("r")).select("r.*")
    return listed.orderBy(F.desc("importance"), "feature").limit(n)
