"""Boosted regression trees on the log loss from histograms of packed codes.

The trees are those of ``GBTClassifier``: the same candidate splits (up to 32 bins from the same sample of rows), the same
gain, tie rule and stopping rules, squared-error trees of the gradients, and leaves that hold mean gradients. The result is a
``GBTClassificationModel``. What differs is the cost of a pass: a row is a few packed codes, one for several features, and
all 0/1 columns of one category are told from one code; only the smaller child of a split is counted, its sibling is what is
left of the parent; gradients are rounded to a fixed step, so that sums are exact and do not depend on the order of rows.

Every pass is one job over kept blocks of codes and margins. Only sums by node, label and bin reach the driver.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.session import shared_base, shared_dir

#: Entries of one packed code, rows of one block, trees between two checkpoints of the margins.
_PACKED, _BLOCK, _CHECKPOINT = 512, 1 << 15, 25
#: Rows that are worth a task of their own.
_TASK_ROWS = 50_000
#: Rows whose values give the candidate splits, as in pyspark.ml.
_SPLIT_ROWS = 10_000
_NODE = ("id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, leftChild int, "
         "rightChild int, split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>")


# --- Codes ------------------------------------------------------------------------

@dataclass(frozen=True)
class Layout:
    """How a row becomes codes. A part is a number with its thresholds, or the 0/1 columns of one category (``thresholds`` is
    None); ``at`` is its first feature and ``size`` its number of bins. ``columns`` lists the parts of each packed code."""

    parts: list[tuple[int, int, np.ndarray | None]]
    columns: list[list[int]]

    def width(self, column: int) -> int:
        return int(np.prod([self.parts[p][1] for p in self.columns[column]]))

    def place(self, part: int) -> tuple[int, int]:
        """Column and stride of a part."""
        for c, members in enumerate(self.columns):
            if part in members:
                return c, int(np.prod([self.parts[p][1] for p in members[members.index(part) + 1:]], initial=1))
        raise KeyError(part)


def layout(thresholds: Sequence[np.ndarray], levels: Sequence[int]) -> Layout:
    """Numbers come first, then the 0/1 columns category by category."""
    parts = [(i, len(t) + 1, np.asarray(t)) for i, t in enumerate(thresholds)]
    at = len(parts)
    for n in levels:
        parts.append((at, n + 1, None))
        at += n
    columns: list[list[int]] = []
    room: list[int] = []
    for p in sorted(range(len(parts)), key=lambda p: -parts[p][1]):
        size = parts[p][1]
        fits = next((c for c, full in enumerate(room) if full * size <= _PACKED), None)
        if fits is None:
            columns.append([p])
            room.append(size)
        else:
            columns[fits].append(p)
            room[fits] *= size
    return Layout(parts, columns)


def encode(x: np.ndarray, lay: Layout) -> np.ndarray:
    """Packed codes, one row per column of the layout."""
    bins = []
    for at, size, thresholds in lay.parts:
        if thresholds is None:
            bins.append((x[:, at:at + size - 1] @ np.arange(1.0, size)).astype(np.int64))
        else:
            bins.append(np.searchsorted(thresholds, x[:, at], side="left"))
    out = np.zeros((len(lay.columns), len(x)), np.int64)
    for c, members in enumerate(lay.columns):
        for p in members:
            out[c] = out[c] * lay.parts[p][1] + bins[p]
    return out.astype(np.uint16 if max(map(lay.width, range(len(lay.columns)))) <= 1 << 16 else np.uint32)


def thresholds_of(values: np.ndarray, weights: np.ndarray, most: int, expected: float) -> np.ndarray:
    """Candidate thresholds of one number, as pyspark.ml takes them from sampled values: all middles if there are few, else one
    per stride of the weight. ``expected`` is the weight of the whole sample; zeros have what the others leave of it."""
    held = values != 0.0
    distinct, where = np.unique(values[held], return_inverse=True)
    sums = np.bincount(where, weights=weights[held], minlength=len(distinct))
    if not len(distinct):
        return np.empty(0)
    rest = expected - sums.sum()
    if rest > np.finfo(float).eps * int(held.sum()) * 100:
        at = int(np.searchsorted(distinct, 0.0))
        distinct, sums = np.insert(distinct, at, 0.0), np.insert(sums, at, rest)
    if len(distinct) - 1 <= most:
        return (distinct[:-1] + distinct[1:]) / 2.0
    stride, found = expected / (most + 1), []
    seen, target = sums[0], expected / (most + 1)
    for i in range(1, len(distinct)):
        before, seen = seen, seen + sums[i]
        if abs(before - target) < abs(seen - target):
            found.append((distinct[i - 1] + distinct[i]) / 2.0)
            target += stride
    return np.array(found)


def _candidates(encoded: DataFrame, numbers: int, rows: int, weight: float, seed: int, bins: int) -> list[np.ndarray]:
    """Thresholds of the numbers, from the rows that pyspark.ml would sample."""
    spark = encoded.sparkSession
    share = min(1.0, max(bins * bins, _SPLIT_ROWS) / rows)
    given = encoded.select("features", "weight")
    if share < 1.0:
        draw = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        drawn = given._jdf.rdd().sample(False, share, draw).toJavaRDD()
        given = DataFrame(spark._jsparkSession.createDataFrame(drawn, given._jdf.schema()), spark)
    sample = given.select(vector_to_array("features").alias("x"), "weight").collect()
    x, w = np.array([r.x for r in sample], float).reshape(len(sample), -1), np.array([r.weight for r in sample], float)
    most = min(bins, rows) - 1
    return [thresholds_of(x[:, i], w, most, share * weight) for i in range(numbers)]


# --- Passes over blocks -----------------------------------------------------------------

@dataclass(frozen=True)
class Route:
    """Where a row goes from each node, by the node's packed code. Nodes are numbered 1, children 2i and 2i + 1; a leaf leads to
    itself. ``steps`` is the depth that is known."""

    column: np.ndarray
    to: np.ndarray
    steps: int

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        n, width = codes.shape[1], self.to.shape[1]
        node, at, flat, to = np.ones(n, np.intp), np.arange(n), codes.ravel(), self.to.ravel()
        for _ in range(self.steps):
            code = flat[self.column[node] * n + at]
            node = to[node * width + code].astype(np.intp)
        return node


def _gradients(label: np.ndarray, margin: np.ndarray, first: bool) -> np.ndarray:
    sign = label * 2.0 - 1.0
    if first:
        return sign
    with np.errstate(over="ignore"):
        return 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))


def _pack(batches: Iterator[pa.RecordBatch], lay: Layout) -> Iterator[pa.RecordBatch]:
    """Rows (x, label) as blocks of packed codes."""
    def block(held: list[tuple]) -> pa.RecordBatch:
        codes = np.concatenate([h[0] for h in held], axis=1)
        label = np.concatenate([h[1] for h in held])
        return pa.RecordBatch.from_pydict({"codes": [codes.tobytes()], "kind": [codes.dtype.str], "label": [label.tobytes()]},
                                          pa.schema([("codes", pa.binary()), ("kind", pa.string()), ("label", pa.binary())]))

    held: list[tuple] = []
    for batch in batches:
        if batch.num_rows:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            held.append((encode(x, lay), batch.column("label").to_numpy(zero_copy_only=False).astype(np.uint8)))
        if sum(len(h[1]) for h in held) >= _BLOCK:
            yield block(held)
            held = []
    if held:
        yield block(held)


def _blocks(batches: Iterator, lay: Layout) -> Iterator[tuple]:
    """Blocks (codes, label, margin, no squares yet) of packed rows."""
    for row in batches:
        label = np.frombuffer(row.label, np.uint8)
        codes = np.frombuffer(row.codes, np.dtype(row.kind)).reshape(len(lay.columns), len(label))
        yield codes, label, np.zeros(len(label)), None


def _squares(label: np.ndarray, node: np.ndarray, gradient: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(node * 2 + label, weights=gradient * gradient, minlength=2 * size)


def _advanced(blocks: Iterator[tuple], route: Route, values: np.ndarray, first: bool) -> Iterator[tuple]:
    """Blocks after one more tree, each with the squared gradients that the tree met, by leaf and label."""
    for codes, label, margin, _ in blocks:
        node = route.nodes(codes)
        yield codes, label, margin + values[node], _squares(label, node, _gradients(label, margin, first), len(values))


def _met(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
    """Summed squares of all blocks."""
    sums = [b[3] for b in blocks]
    if sums:
        yield np.sum(sums, axis=0)


def _histograms(blocks: Iterator[tuple], lay: Layout, route: Route, slot: np.ndarray, scale: float, first: bool) -> Iterator[tuple]:
    """(rows, gradients in steps, squares of the tree before) by slot, label and bin, over the nodes that have a slot."""
    slots = int(slot.max()) + 1
    widths = [lay.width(c) for c in range(len(lay.columns))]
    rows = [np.zeros(slots * 2 * w) for w in widths]
    sums = [np.zeros(slots * 2 * w) for w in widths]
    met, any_rows = None, False
    for codes, label, margin, squares in blocks:
        if squares is not None:
            met = squares if met is None else met + squares
        if route.steps:
            place = slot[route.nodes(codes)]
            kept = np.flatnonzero(place >= 0)
            if not len(kept):
                continue
            base, label, margin, codes = place[kept] * 2 + label[kept], label[kept], margin[kept], np.take(codes, kept, axis=1)
        else:
            base = label.astype(np.intp)
        any_rows = True
        steps = np.rint(_gradients(label, margin, first) * scale)
        for c, width in enumerate(widths):
            index = base * width + codes[c]
            rows[c] += np.bincount(index, minlength=len(rows[c]))
            sums[c] += np.bincount(index, weights=steps, minlength=len(sums[c]))
    if any_rows or met is not None:
        yield _by_part(rows, lay, slots), _by_part(sums, lay, slots), met


def _by_part(packed: list[np.ndarray], lay: Layout, slots: int) -> np.ndarray:
    """Sums by slot, label and bin of each part, parts side by side. All are whole numbers, so nothing is rounded."""
    out: list[np.ndarray] = [np.empty(0)] * len(lay.parts)
    for sums, members in zip(packed, lay.columns):
        cube = sums.reshape(slots, 2, *[lay.parts[p][1] for p in members])
        for axis, p in enumerate(members, 2):
            out[p] = cube.sum(axis=tuple(a for a in range(2, cube.ndim) if a != axis))
    return np.concatenate(out, axis=2)


# --- Splits -----------------------------------------------------------------------------

@dataclass
class _Node:
    rows: np.ndarray
    steps: np.ndarray
    split: tuple[int, int, bool] | None = None
    gain: float = -1.0
    squares: np.ndarray | None = None


def _lefts(hist: np.ndarray, lay: Layout) -> np.ndarray:
    """One side of every candidate split, by node and label; features in order. Of a 0/1 column it is the side of the ones."""
    out, at = [], 0
    for _, size, thresholds in lay.parts:
        own = hist[:, :, at:at + size]
        out.append(own[:, :, 1:] if thresholds is None else np.cumsum(own, axis=2)[:, :, :-1])
        at += size
    return np.concatenate(out, axis=2)


def _best(rows: np.ndarray, steps: np.ndarray, lay: Layout, weights: np.ndarray, scale: float) -> list[tuple]:
    """The first best split of each node: (candidate, gain, rows and gradients of its side), or None where nothing is gained."""
    size = lay.parts[0][1]
    total_n, total_s = rows[:, :, :size].sum(axis=2), steps[:, :, :size].sum(axis=2)
    left_n, left_s = _lefts(rows, lay), _lefts(steps, lay)
    right_n, right_s = total_n[:, :, None] - left_n, total_s[:, :, None] - left_s

    def weighed(a: np.ndarray) -> np.ndarray:
        return np.tensordot(a, weights, axes=(1, 0)) if a.ndim == 3 else a @ weights

    w, s = weighed(total_n), weighed(total_s) / scale
    if not left_n.shape[2]:
        return [None] * len(rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        lw, rw, ls, rs = weighed(left_n), weighed(right_n), weighed(left_s) / scale, weighed(right_s) / scale
        gains = (ls * ls / lw + rs * rs / rw - (s * s / w)[:, None]) / w[:, None]
    gains[(left_n.sum(axis=1) < 1) | (right_n.sum(axis=1) < 1)] = -np.inf
    out = []
    for i, m in enumerate(gains.argmax(axis=1)):
        real = gains[i, m] > 1e-14 * (s[i] / w[i]) ** 2  # what is less comes from rounding
        out.append((int(m), float(gains[i, m]), left_n[i, :, m], left_s[i, :, m]) if real else None)
    return out


def _candidate(m: int, lay: Layout) -> tuple[int, int]:
    """(part, bin) of a candidate: numbers up to and with the bin go left; the bin of a 0/1 column is its code."""
    for p, (_, size, thresholds) in enumerate(lay.parts):
        if m < size - 1:
            return p, m + (thresholds is None)
        m -= size - 1
    raise IndexError(m)


class _Tree:
    """One tree while it grows."""

    def __init__(self, lay: Layout, depth: int, weights: np.ndarray, scale: float):
        self.lay, self.depth, self.weights, self.scale = lay, depth, weights, scale
        self.size = 2 << depth
        self.nodes: dict[int, _Node] = {}
        self.column = np.zeros(self.size, np.intp)
        self.to = np.repeat(np.arange(self.size, dtype=np.uint16 if self.size <= 1 << 16 else np.uint32)[:, None],
                            max(map(lay.width, range(len(lay.columns)))), axis=1)

    def mean(self, rows: np.ndarray, steps: np.ndarray) -> float:
        w = float(rows @ self.weights)
        return float(steps @ self.weights) / self.scale / w if w else np.inf

    def route(self, steps: int) -> Route:
        return Route(self.column, self.to, steps)

    def split(self, i: int, m: int, gain: float, rows: np.ndarray, steps: np.ndarray) -> None:
        node = self.nodes[i]
        part, bound = _candidate(m, self.lay)
        sides = [(rows, steps), (node.rows - rows, node.steps - steps)]
        width = self.lay.parts[part][1]
        goes_left = np.arange(width) <= bound
        if self.lay.parts[part][2] is None:  # of a 0/1 column the value with the lower mean goes left, 0 if they are equal
            goes_left = np.arange(width) == bound
            if self.mean(*sides[1]) <= self.mean(*sides[0]):
                sides, goes_left = sides[::-1], ~goes_left
        node.split, node.gain = (part, bound, bool(goes_left[0])), gain
        column, stride = self.lay.place(part)
        self.column[i] = column
        codes = np.arange(self.lay.width(column)) // stride % width
        self.to[i, :len(codes)] = np.where(goes_left[codes], 2 * i, 2 * i + 1)
        for child, (n, s) in zip((2 * i, 2 * i + 1), sides):
            self.nodes[child] = _Node(n, s)

    def values(self) -> np.ndarray:
        out = np.zeros(self.size)
        for i, node in self.nodes.items():
            out[i] = self.mean(node.rows, node.steps)
        return out

    def measure(self, met: np.ndarray) -> None:
        """Squared gradients of the leaves, and of the nodes above them."""
        for i in sorted(self.nodes, reverse=True):
            node = self.nodes[i]
            node.squares = met.reshape(-1, 2)[i] if node.split is None else self.nodes[2 * i].squares + self.nodes[2 * i + 1].squares

    def saved(self) -> list[tuple]:
        """The nodes as pyspark.ml saves them, numbered in preorder."""
        number: dict[int, int] = {}
        stack = [1]
        while stack:
            i = stack.pop()
            number[i] = len(number)
            if self.nodes[i].split is not None:
                stack += [2 * i + 1, 2 * i]
        out = []
        for i, k in number.items():
            node = self.nodes[i]
            w, s, ss = float(node.rows @ self.weights), float(node.steps @ self.weights) / self.scale, float(node.squares @ self.weights)
            ends, split = (-1, -1), (-1, [], -1)
            if node.split is not None:
                ends = (number[2 * i], number[2 * i + 1])
                part, bound, zero_left = node.split
                at, _, thresholds = self.lay.parts[part]
                split = (at + bound - 1, [0.0 if zero_left else 1.0], 2) if thresholds is None else (at, [float(thresholds[bound])], -1)
            out.append((k, s / w, max(0.0, (ss - s * s / w) / w), [w, s, ss], int(node.rows.sum()), node.gain, *ends, split))
        return out


# --- Fit --------------------------------------------------------------------------------

def fit_trees(encoded: DataFrame, numbers: int, levels: Sequence[int], estimator: GBTClassifier) -> GBTClassificationModel:
    """The model of ``estimator`` for rows (features, label 0 or 1, weight), the weight being that of the label. Features are
    ``numbers`` and then 0/1 columns, ``levels`` of them to each category, of which a row holds at most one."""
    spark = encoded.sparkSession
    facts = {r.label: r for r in encoded.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.min("weight").alias("low"), F.max("weight").alias("high")).limit(3).collect()}
    if not facts or set(facts) - {0, 1} or any(f.low != f.high for f in facts.values()):
        raise ValueError("trees are fitted on rows of labels 0 and 1, each label with one weight")
    total, weights = sum(f.n for f in facts.values()), np.array([facts[v].low if v in facts else 0.0 for v in (0, 1)])
    weight = sum(f.n * f.low for f in facts.values())
    lay = layout(_candidates(encoded, numbers, total, weight, estimator.getSeed(), estimator.getMaxBins()), levels)
    packed = encoded.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("label")).mapInArrow(
        partial(_pack, lay=lay), "codes binary, kind string, label binary")
    tasks = max(1, min(spark.sparkContext.defaultParallelism, ceil(total / _TASK_ROWS)))
    blocks = packed.rdd.coalesce(tasks).mapPartitions(partial(_blocks, lay=lay))
    trees = _boost(spark, blocks, lay, weights, total, estimator)
    return _model(spark, trees, numbers + sum(levels), estimator)


def _boost(spark: SparkSession, blocks: RDD, lay: Layout, weights: np.ndarray, total: int, estimator: GBTClassifier) -> list[_Tree]:
    depth, trees = estimator.getMaxDepth(), []
    # A gradient is at most 4 in size: sums of all rows stay below 2^53 steps and are exact.
    scale = 2.0 ** (50 - max(1, total - 1).bit_length())
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_base(spark))
    state, before, saved = blocks.persist(StorageLevel.MEMORY_AND_DISK), None, None
    try:
        for t in range(estimator.getMaxIter()):
            tree = _Tree(lay, depth, weights, scale)

            def summed(slot: np.ndarray, steps: int) -> tuple:
                found = state.mapPartitions(partial(
                    _histograms, lay=lay, route=tree.route(steps), slot=slot, scale=scale, first=t == 0)).collect()
                return sum(f[0] for f in found), sum(f[1] for f in found), [f[2] for f in found if f[2] is not None]

            rows, steps, met = summed(np.array([-1, 0]), 0)
            if trees:
                trees[-1].measure(np.sum(met, axis=0))
                before.unpersist()
            _grow(tree, rows[0], steps[0], summed)
            trees.append(tree)
            before, state = state, state.mapPartitions(partial(
                _advanced, route=tree.route(depth), values=tree.values() * (estimator.getStepSize() if t else 1.0), first=t == 0,
            )).persist(StorageLevel.MEMORY_AND_DISK)
            if (t + 1) % _CHECKPOINT == 0 and t + 1 < estimator.getMaxIter():  # a lost block is made again from the last checkpoint
                state.checkpoint()
                state.count()
                saved, old = state.getCheckpointFile(), saved
                _drop(spark, old)
        trees[-1].measure(np.sum(state.mapPartitions(_met).collect(), axis=0))
    finally:
        for rdd in (before, state):
            if rdd is not None:
                rdd.unpersist()
        _drop(spark, saved)
    return trees


def _grow(tree: _Tree, rows: np.ndarray, steps: np.ndarray, summed) -> None:
    """Splits level by level. ``summed`` counts the nodes that are given a slot."""
    size = tree.lay.parts[0][1]
    tree.nodes[1] = _Node(rows[:, :size].sum(axis=1), steps[:, :size].sum(axis=1))
    hists = {1: (rows, steps)}
    for level in range(tree.depth):
        ids = sorted(hists)
        found = _best(np.stack([hists[i][0] for i in ids]), np.stack([hists[i][1] for i in ids]), tree.lay, tree.weights, tree.scale)
        for i, best in zip(ids, found):
            if best is not None:
                tree.split(i, *best)
        parents = [i for i in ids if tree.nodes[i].split is not None]
        if not parents or level + 1 == tree.depth:
            return
        small = [min((2 * i, 2 * i + 1), key=lambda c: tree.nodes[c].rows.sum()) for i in parents]
        slot = np.full(tree.size, -1)
        slot[small] = np.arange(len(small))
        rows, steps, _ = summed(slot, level + 1)
        below = {}
        for k, (i, c) in enumerate(zip(parents, small)):
            below[c] = rows[k], steps[k]
            below[c ^ 1] = hists[i][0] - rows[k], hists[i][1] - steps[k]
        hists = below


def _drop(spark: SparkSession, path: str | None) -> None:
    """Deletes a checkpoint that a later one has replaced."""
    if path:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _model(spark: SparkSession, trees: list[_Tree], n_features: int, estimator: GBTClassifier) -> GBTClassificationModel:
    """The trees written in the form of a saved model, and loaded."""
    path = shared_dir(spark, "boosted")
    stamp = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}

    def body(kind: str, uid: str, names: set[str] | None = None, **more) -> str:
        def of(given: dict) -> dict:
            return {p.name: v for p, v in given.items() if names is None or p.name in names}

        return json.dumps({"class": f"org.apache.spark.ml.{kind}", **stamp, "uid": uid, "paramMap": of(estimator._paramMap),
                           "defaultParamMap": of(estimator._defaultParamMap), **more})

    own = {p.name for p in DecisionTreeRegressionModel().params}
    tree = "regression.DecisionTreeRegressionModel"
    spark.createDataFrame([(body("classification.GBTClassificationModel", estimator.uid, numFeatures=n_features, numTrees=len(trees)),)],
                          "value string").coalesce(1).write.text(f"{path}/metadata")
    weights = [1.0 if t == 0 else float(estimator.getStepSize()) for t in range(len(trees))]
    spark.createDataFrame([(t, body(tree, f"{estimator.uid}_{t}", own), w) for t, w in enumerate(weights)],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(t, node) for t, tree in enumerate(trees) for node in tree.saved()],
                          f"treeID int, nodeData struct<{_NODE}>").coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)
