"""Exact nearest neighbours: a k-d cut of space into bounded cells, and visits to the cells that a ball meets.

1. Equal points become one location that keeps the ids its neighbours may need, so a point held by a third of all rows is one
   row from there on.
2. Space is cut between flags and at medians of samples until no cell holds more than ``CELL_ROWS`` locations. Cuts only steer balance.
3. Inside its own cell every location finds its nearest ids; the last of them bounds a ball.
4. Every location visits the other cells whose box (the bounds of their locations) that ball meets. Visitors of a popular cell
   are dealt out in chunks, each with a copy of the cell. What the visits bring is merged with what was found at home.

Inside a cell a matrix product, with a bound on its rounding, tells which pairs need their distance added up. Neighbours are
ordered by (squared distance, hash of the id, id); the result equals the comparison of all pairs. The driver holds the cuts and
the boxes: one number and one dimension per cell, and two numbers per cell and dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlake.session import shared_dir

#: Locations of one cell, visitors of one chunk, and cells that one cell is cut into at a time.
CELL_ROWS, CHUNK_ROWS, FAN = 2048, 4096, 1024
_SAMPLES = 48
#: Sampled rows that choose one cut, and the least share of them on either side of a two-valued dimension.
_CHOOSERS, _LEAST = 2048, 1 / 32
#: Pairs that are compared at a time.
_PAIRS = 1 << 19
_FOUND = "array<struct<d: double, h: long, id: string, x: array<double>>>"
_ARROW = pa.list_(pa.struct([("d", pa.float64()), ("h", pa.int64()), ("id", pa.string()), ("x", pa.list_(pa.float64()))]))


@dataclass
class Cuts:
    """A k-d tree as arrays: ``dim`` and ``cut`` of inner nodes; a leaf has dim -1 and is named by its node number."""

    dim: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])

    def graft(self, leaf: int, splits: list[tuple[int, float, int, int]]) -> None:
        """Replace a leaf by the nodes of its own tree, numbered from 0."""
        base = len(self.dim) - 1
        at = [leaf] + [base + i for i in range(1, len(splits))]
        self.dim += [-1] * (len(splits) - 1)
        self.cut += [0.0] * (len(splits) - 1)
        self.left += [-1] * (len(splits) - 1)
        self.right += [-1] * (len(splits) - 1)
        for i, (dim, cut, left, right) in enumerate(splits):
            self.dim[at[i]], self.cut[at[i]] = dim, cut
            if dim >= 0:
                self.left[at[i]], self.right[at[i]] = at[left], at[right]

    def packed(self) -> tuple[np.ndarray, ...]:
        return np.array(self.dim), np.array(self.cut), np.array(self.left), np.array(self.right)


def _choose(rows: np.ndarray) -> tuple[int, float, bool] | None:
    """Dimension and value to cut at, and whether this is a median; None if all rows are one point.

    A dimension of two values, as a 0/1 input is, keeps the sides apart whatever the reach of a ball, so the one that parts its
    rows best goes first. Without one the widest dimension is cut at its median.
    """
    low, width = rows.min(axis=0), rows.max(axis=0) - rows.min(axis=0)
    above = rows > low
    share = above.mean(axis=0)
    two = (width > 0) & (~above | (rows == low + width)).all(axis=0) & (share >= _LEAST) & (share <= 1 - _LEAST)
    if two.any():
        dim = int(np.argmax(np.where(two, width * np.sqrt(share * (1 - share)), 0.0)))
        return dim, float(rows[:, dim].max()), False
    dim = int(np.argmax(width))
    values = np.sort(rows[:, dim])
    cut = values[len(values) // 2]
    if cut == values[0]:  # everything below the median is one value: cut behind it
        above = values[values > cut]
        if not len(above):
            return None
        cut = above[0]
    return dim, float(cut), True


def split_sample(points: np.ndarray, parts: int) -> list[tuple[int, float, int, int]]:
    """Nodes that cut the sample into about ``parts`` parts of like size."""
    nodes: list[tuple[int, float, int, int]] = [(-1, 0.0, -1, -1)]
    todo = [(0, points, parts)]
    while todo:
        node, rows, parts = todo.pop()
        if parts < 2 or len(rows) < 2:
            continue
        chosen = _choose(rows[::-(-len(rows) // _CHOOSERS)])
        if chosen is None:
            continue
        dim, cut, median = chosen
        below = rows[:, dim] < cut
        at = len(nodes)
        nodes += [(-1, 0.0, -1, -1)] * 2
        nodes[node] = (dim, cut, at, at + 1)
        first = parts // 2 if median else min(parts - 1, max(1, round(parts * below.mean())))
        todo += [(at, rows[below], first), (at + 1, rows[~below], parts - first)]
    return nodes


def leaf_of(tree: tuple[np.ndarray, ...], points: np.ndarray) -> np.ndarray:
    dim, cut, left, right = tree
    node = np.zeros(len(points), dtype=np.int64)
    live = np.flatnonzero(dim[node] >= 0)
    while len(live):
        here = node[live]
        node[live] = np.where(points[live, dim[here]] < cut[here], left[here], right[here])
        live = live[dim[node[live]] >= 0]
    return node


def _cut_boxes(tree: tuple[np.ndarray, ...], dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds that the cuts give each node."""
    dim, cut, left, right = tree
    low, high = np.full((len(dim), dims), -np.inf), np.full((len(dim), dims), np.inf)
    for node in np.flatnonzero(dim >= 0):  # children come behind their parent
        for child in (left[node], right[node]):
            low[child], high[child] = low[node], high[node]
        high[left[node], dim[node]] = low[right[node], dim[node]] = cut[node]
    return low, high


def leaves_met(tree: tuple[np.ndarray, ...], points: np.ndarray, reach: np.ndarray,
               boxes: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf whose box is within ``reach`` (squared) of a row's point. Boxes are those of the cuts, or the
    lower and upper bounds of what each node holds."""
    dim, _, left, right = tree
    low, high = boxes or _cut_boxes(tree, points.shape[1])
    limit = reach * (1 + 1e-9)  # the box distance is rounded otherwise than distances: never miss a tie
    out: list[tuple[np.ndarray, int]] = []
    todo = [(0, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        here = points[rows]
        with np.errstate(over="ignore"):
            off = np.maximum(np.maximum(low[node] - here, here - high[node]), 0.0)
            rows = rows[(off * off).sum(axis=1) <= limit[rows]]
        if len(rows) and dim[node] < 0:
            out.append((rows, node))
        elif len(rows):
            todo += [(left[node], rows), (right[node], rows)]
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([r for r, _ in out]), np.concatenate([np.full(len(r), n) for r, n in out])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    flat = np.concatenate([np.empty(0), *[c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]])
    return flat.reshape(len(column), -1)


def _close_pairs(queries: np.ndarray, bound: np.ndarray, places: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, place) of all pairs that can be among the query's ``wanted`` nearest places within its bound, and few others."""
    centre = places.mean(axis=0)
    q, p = queries - centre, places - centre
    q2, p2 = (q * q).sum(axis=1), (p * p).sum(axis=1)
    about = (q @ p.T) * -2.0
    about += q2[:, None]
    about += p2
    # What the products may be off by, for each of the two sides of a comparison. Comparisons with what overflows keep the pair.
    off = np.finfo(float).eps * (4 * places.shape[1] + 32) * (q2 + p2.max())
    limit = bound * (1 + 1e-9) + off
    far = about > limit[:, None]
    if len(places) > wanted and far.size - np.count_nonzero(far) > 4 * wanted * len(q):
        last = np.partition(about, wanted - 1, axis=1)[:, wanted - 1]
        far = about > np.minimum(limit, last + 2 * off)[:, None]
    return np.nonzero(~far)


def _nearest(queries: np.ndarray, bound: np.ndarray, cell: pa.Table, wanted: int) -> tuple[np.ndarray, pa.Array]:
    """Per query the ``wanted`` nearest ids of the cell within its bound: squared distance of the last one wanted (infinite if
    there are fewer), and the lists."""
    places, held = _matrix(cell["x"]), cell["h"].combine_chunks()
    counts = np.diff(held.offsets.to_numpy())
    starts = np.cumsum(counts) - counts
    hashes, ids = held.flatten().to_numpy(), cell["ids"].combine_chunks().flatten()
    names = np.asarray(ids.to_pylist(), dtype=object)
    found: list[tuple[np.ndarray, ...]] = []
    step = max(1, _PAIRS // max(len(places), 1))
    for at in range(0, len(queries), step):
        q = queries[at:at + step]
        with np.errstate(over="ignore", invalid="ignore"):
            rows, cols = _close_pairs(q, bound[at:at + step], places, wanted)
            d = np.zeros(len(rows))
            for j in range(places.shape[1]):
                d += (q[rows, j] - places[cols, j]) ** 2
        near = d <= bound[at + rows]
        rows, cols, d = rows[near], cols[near], d[near]
        reps = counts[cols]
        inner = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        entry = np.repeat(starts[cols], reps) + inner
        rows, cols, d = np.repeat(rows, reps), np.repeat(cols, reps), np.repeat(d, reps)
        order = np.lexsort((names[entry].astype(str), hashes[entry], d, rows))
        rows, cols, entry, d = rows[order], cols[order], entry[order], d[order]
        first = np.searchsorted(rows, np.arange(len(q)))
        keep = np.arange(len(rows)) - first[rows] < wanted
        found.append((rows[keep] + at, cols[keep], entry[keep], d[keep]))
    empty = np.empty(0, np.int64)
    rows, cols, entry, d = (np.concatenate(part) for part in zip((empty, empty, empty, np.empty(0)), *found))
    size = np.bincount(rows, minlength=len(queries))
    ends = np.cumsum(size)
    reach = np.full(len(queries), np.inf)
    reach[size == wanted] = d[ends[size == wanted] - 1]
    entries = pa.StructArray.from_arrays(
        [pa.array(d), pa.array(hashes[entry]), ids.take(pa.array(entry)), cell["x"].combine_chunks().take(pa.array(cols))], ["d", "h", "id", "x"])
    return reach, pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), entries)


def _locations(points: DataFrame, keep: int) -> DataFrame:
    """(loc, x, h, ids): one row per distinct point, with its first ``keep`` ids by hash; written, so that numbers stay."""
    spark = points.sparkSession
    line = Window.partitionBy("x").orderBy("h", "id")
    # The limit is also applied before the shuffle, so copies of one point do not travel.
    first = points.select("x", F.xxhash64("id").alias("h"), "id").withColumn("_r", F.row_number().over(line)).filter(F.col("_r") <= keep)
    listed = first.groupBy("x").agg(F.sort_array(F.collect_list(F.struct("h", F.col("id").cast("string").alias("id")))).alias("a"))
    folder = shared_dir(spark, "locations")
    listed.select(F.monotonically_increasing_id().alias("loc"), "x", F.col("a.h").alias("h"), F.col("a.id").alias("ids")).write.parquet(folder)
    return spark.read.parquet(folder)


def _with_cell(locations: DataFrame, cuts: Cuts) -> DataFrame:
    tree = cuts.packed()

    @F.pandas_udf("long")
    def cell(x: pd.Series) -> pd.Series:
        return pd.Series(leaf_of(tree, np.stack(x.to_numpy())) if len(x) else [], dtype="int64")

    return locations.withColumn("cell", cell("x"))


def cut_space(locations: DataFrame, cell_rows: int = CELL_ROWS) -> Cuts:
    """Cuts until no cell holds over ``cell_rows`` locations. A sample of bounded size per round and cell decides where."""
    cuts, stuck = Cuts(), set()
    while True:
        sizes = {r.cell: r.n for r in _with_cell(locations, cuts).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        large = {c: n for c, n in sizes.items() if n > cell_rows and c not in stuck}
        if not large:
            return cuts
        parts = {c: min(FAN, -(-2 * n // cell_rows)) for c, n in large.items()}
        shares = {c: min(1.0, _SAMPLES * parts[c] / n) for c, n in large.items()}

        @F.pandas_udf("double")
        def share(cell: pd.Series) -> pd.Series:
            return cell.map(shares).fillna(0.0).astype("float64")

        u = F.pmod(F.xxhash64("loc", F.lit(len(cuts.dim))), F.lit(1 << 30)) / F.lit(float(1 << 30))
        picked = _with_cell(locations, cuts).filter(u < share("cell"))

        def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            nodes = split_sample(np.stack(rows["x"].to_numpy()), parts[key[0]])
            dim, cut, left, right = zip(*nodes)
            return pd.DataFrame({"cell": [key[0]], "dim": [dim], "cut": [cut], "left": [left], "right": [right]})

        grown = picked.select("cell", "x").groupBy("cell").applyInPandas(
            grow, "cell long, dim array<int>, cut array<double>, left array<int>, right array<int>").collect()
        stuck |= set(large) - {r.cell for r in grown if len(r.dim) > 1}
        for r in grown:
            if len(r.dim) > 1:
                cuts.graft(r.cell, list(zip(r.dim, r.cut, r.left, r.right)))


def _at_home(located: DataFrame, wanted: int) -> DataFrame:
    """(loc, cell, x, reach, found): nearest ids of the own cell, and the squared distance that later finds must not exceed."""

    def search(rows: pa.Table) -> pa.Table:
        reach, found = _nearest(_matrix(rows["x"]), np.full(len(rows), np.inf), rows, wanted)
        return pa.table({"loc": rows["loc"], "cell": rows["cell"], "x": rows["x"], "reach": reach, "found": found})

    return located.groupBy("cell").applyInArrow(search, f"loc long, cell long, x array<double>, reach double, found {_FOUND}")


def _boxes(home: DataFrame, cuts: Cuts) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of what each node of the cuts holds."""

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = pa.Table.from_batches([batch])
                x, cell = _matrix(rows["x"]), rows["cell"].to_numpy()
                order = np.argsort(cell, kind="stable")
                own, first = np.unique(cell[order], return_index=True)
                yield pa.RecordBatch.from_pydict({
                    "cell": own, "low": list(np.minimum.reduceat(x[order], first)), "high": list(np.maximum.reduceat(x[order], first))})

    # Cells were written one after the other, so there are about as many rows as cells.
    rows = home.select("cell", "x").mapInArrow(bounds, "cell long, low array<double>, high array<double>").toArrow()
    cell, low, high = rows["cell"].to_numpy(), _matrix(rows["low"]), _matrix(rows["high"])
    lows, highs = np.full((len(cuts.dim), low.shape[1]), np.inf), np.full((len(cuts.dim), low.shape[1]), -np.inf)
    np.minimum.at(lows, cell, low)
    np.maximum.at(highs, cell, high)
    for node in range(len(cuts.dim) - 1, -1, -1):  # children come behind their parent
        if cuts.dim[node] >= 0:
            children = [cuts.left[node], cuts.right[node]]
            lows[node], highs[node] = lows[children].min(axis=0), highs[children].max(axis=0)
    return lows, highs


def _visits(home: DataFrame, cuts: Cuts) -> DataFrame:
    """(cell, loc, x, reach) of every other cell that a location's ball meets."""
    tree, boxes = cuts.packed(), _boxes(home, cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = pa.Table.from_batches([batch.slice(at, 1024)])
                row, leaf = leaves_met(tree, _matrix(part["x"]), part["reach"].to_numpy(), boxes)
                away = leaf != part["cell"].to_numpy()[row]
                out = part.select(["loc", "x", "reach"]).take(pa.array(row[away]))
                yield from out.add_column(0, "cell", pa.array(leaf[away], pa.int64())).to_batches()

    return home.select("loc", "cell", "x", "reach").mapInArrow(run, "cell long, loc long, x array<double>, reach double")


def _served(located: DataFrame, visits: DataFrame, wanted: int) -> DataFrame:
    """(loc, found) of what the visited cells hold within reach."""
    chunks = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).cast("int").alias("_n"))
    chunks = F.broadcast(chunks)  # one row per cell, like the cuts
    hosts = located.join(chunks, "cell").withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n")
    guests = visits.join(chunks, "cell").withColumn("_chunk", F.pmod(F.xxhash64("loc"), F.col("_n")).cast("int")).drop("_n")

    def serve(rows: pa.Table, asking: pa.Table) -> pa.Table:
        if not len(rows) or not len(asking):
            return pa.table({"loc": pa.array([], pa.int64()), "found": pa.array([], _ARROW)})
        _, found = _nearest(_matrix(asking["x"]), asking["reach"].to_numpy(), rows, wanted)
        return pa.table({"loc": asking["loc"], "found": found}).filter(pa.array(np.diff(found.offsets.to_numpy()) > 0))

    keys = ("cell", "_chunk")
    return hosts.groupBy(*keys).cogroup(guests.groupBy(*keys)).applyInArrow(serve, f"loc long, found {_FOUND}")


def nearest_neighbours(points: DataFrame, k: int = 5, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(id, x, neighbours): the ``k`` nearest other points of each point of (id, x array<double>), as {d, id, x} structs with
    d the squared distance. Fewer than ``k`` where there are no more points. Ids are unique; coordinates are finite."""
    spark, kind = points.sparkSession, points.schema["id"].dataType.simpleString()
    locations = _locations(points, k + 1)
    cuts = cut_space(locations, cell_rows)
    located = _with_cell(locations, cuts)
    folder = shared_dir(spark, "near-home")
    _at_home(located, k + 1).write.parquet(folder)
    home = spark.read.parquet(folder)
    found = home.select("loc", "found")
    if len(cuts.dim) > 1:
        found = found.unionByName(_served(located, _visits(home, cuts), k + 1))
    # A location has one list from home and one from each cell that held something nearer.
    best = found.groupBy("loc").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))), 1, k + 1).alias("found"))
    near = best.join(home.select("loc", F.col("x").alias("_x")), "loc").drop("loc")
    typed = F.transform("found", lambda f: F.struct(f["d"].alias("d"), f["id"].cast(kind).alias("id"), f["x"].alias("x")))
    others = F.slice(F.filter(typed, lambda f: f["id"] != F.col("id")), 1, k)
    return points.join(near, F.col("x") == F.col("_x")).select("id", "x", others.alias("neighbours"))
