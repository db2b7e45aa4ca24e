"""Exact neighbours and oversampling against comparison of all pairs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadlake.operators import neighbours, prep


def brute(ids, hashes, points, k):
    """Ids and squared distances of the k nearest others, in the order (distance, hash, id)."""
    out = {}
    for i, p in enumerate(points):
        gaps = np.zeros(len(points))
        for j in range(points.shape[1]):
            gaps += (points[:, j] - p[j]) ** 2
        order = np.lexsort((np.array([str(x) for x in ids]), hashes, gaps))
        near = [o for o in order if o != i][:k]
        out[ids[i]] = [(gaps[o], ids[o]) for o in near]
    return out


def frame(spark, ids, points):
    return spark.createDataFrame([(i, [float(c) for c in p]) for i, p in zip(ids, points)], "id long, x array<double>")


def check(spark, points, k, cell_rows):
    ids = list(range(1000, 1000 + len(points)))
    df = frame(spark, ids, points)
    hashes = np.array([r.h for r in df.select(F.xxhash64("id").alias("h")).collect()])
    want = brute(ids, hashes, np.array(points, dtype=float), k)
    got = {r.id: [(n.d, n.id) for n in r.neighbours] for r in neighbours.nearest_neighbours(df, k, cell_rows).collect()}
    assert got == want


def test_neighbours_equal_all_pairs_on_three_thousand_points(spark):
    check(spark, np.random.default_rng(1).normal(size=(3000, 4)), 5, 128)


def test_neighbours_with_ties_copies_and_flat_dimensions(spark):
    rng = np.random.default_rng(2)
    grid = rng.integers(0, 6, size=(700, 3)).astype(float)
    same = np.tile([[2.0, 2.0, 2.0]], (350, 1))
    check(spark, np.concatenate([grid, same, [[1e9, 0, 0]]]), 4, 16)
    check(spark, np.column_stack([rng.exponential(size=400), np.zeros(400)]), 3, 10)


def test_fewer_points_than_neighbours(spark):
    rows = neighbours.nearest_neighbours(frame(spark, [1, 2, 3], [[0.0], [1.0], [5.0]]), 5).collect()
    assert {r.id: [n.id for n in r.neighbours] for r in rows} == {1: [2, 3], 2: [1, 3], 3: [2, 1]}
    assert neighbours.nearest_neighbours(frame(spark, [], []), 5).count() == 0


def test_cells_are_bounded_and_met_leaves_are_complete(spark):
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(size=(1500, 2)), rng.normal(size=(1500, 2)) * 1e-3 + 9])
    located = neighbours._locations(frame(spark, range(3000), points), 2)
    cuts = neighbours.cut_space(located, 100)
    sizes = [r["count"] for r in neighbours._with_cell(located, cuts).groupBy("cell").count().collect()]
    assert max(sizes) <= 100 and sum(sizes) == 3000
    tree, reach = cuts.packed(), rng.uniform(0, 4, 50)
    leaves = neighbours.leaf_of(tree, points)
    rows, met = neighbours.leaves_met(tree, points[:50], reach)
    found = set(zip(rows.tolist(), met.tolist()))
    for i in range(50):
        inside = ((points - points[i]) ** 2).sum(axis=1) <= reach[i]
        assert all((i, leaf) in found for leaf in set(leaves[inside].tolist()))


def test_balls_meet_few_cells_among_flags(spark):
    """0/1 inputs keep cells apart, as they do in encoded rows. Median cuts and their bounds alone met 33.7 of 63 cells here."""
    rng = np.random.default_rng(5)
    flags = [np.eye(n)[rng.integers(0, n, 4000)] for n in (6, 4, 3)]
    points = np.concatenate([rng.uniform(-1.7, 1.7, (4000, 4)), *flags], axis=1)
    located = neighbours._locations(frame(spark, range(4000), points), 6)
    cuts = neighbours.cut_space(located, 128)
    home = neighbours._at_home(neighbours._with_cell(located, cuts), 6).persist()
    assert neighbours._visits(home, cuts).count() / 4000 < 0.15 * home.select("cell").distinct().count()
    home.unpersist()


def test_neighbours_far_from_the_origin_and_beyond_squares(spark):
    """What the matrix product rounds away or overflows must not change the result."""
    rng = np.random.default_rng(6)
    far = np.round(rng.normal(size=(500, 3)), 2) + 1e7
    check(spark, far, 4, 64)
    check(spark, np.concatenate([rng.normal(size=(60, 2)), rng.normal(size=(8, 2)) * 1e160]), 3, 32)


def test_pairs_are_compared_in_bounded_blocks(monkeypatch):
    """The memory of one search does not grow with the visitors of a cell; at once, these would be 2 million pairs."""
    seen, close = [], neighbours._close_pairs
    monkeypatch.setattr(neighbours, "_close_pairs", lambda q, b, p, w: seen.append(len(q) * len(p)) or close(q, b, p, w))
    x = np.random.default_rng(7).normal(size=(512, 3))
    cell = pa.table({"x": list(x), "h": [[i] for i in range(512)], "ids": [[str(i)] for i in range(512)]})
    reach, found = neighbours._nearest(np.tile(x, (8, 1)), np.full(4096, np.inf), cell, 3)
    assert len(found) == 4096 and np.isfinite(reach).all() and found[0][0]["id"].as_py() == "0"
    assert sum(seen) == 4096 * 512 and max(seen) <= neighbours._PAIRS


def test_copies_do_not_travel(spark):
    """The limit on ids of one location is applied before the shuffle."""
    df = spark.range(100).select("id", F.array(F.lit(1.0)).alias("x"))
    line = neighbours._locations(df, 3).collect()
    assert len(line) == 1 and len(line[0].ids) == 3


def test_smote_lifts_all_classes_from_complete_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "a", float(v[0]), float(v[1])) for i, v in enumerate(rng.normal(size=(200, 2)))]
    rows += [(1000 + i, "b", float(v[0]), float(v[1])) for i, v in enumerate(rng.normal(size=(40, 2)) + 5)]
    rows += [(2000 + i, "c", float(v[0]), float(v[1])) for i, v in enumerate(rng.normal(size=(3, 2)) - 5)]
    rows += [(3000, "c", None, 1.0), (3001, "b", float("nan"), 1.0), (4000, "d", 1.0, 1.0)]
    out = prep.smote(spark.createDataFrame(rows, "id long, label string, p double, q double"), ["p", "q"], "label", "id").collect()
    sizes = {c: sum(r.label == c for r in out) for c in "abcd"}
    assert sizes == {"a": 200, "b": 200, "c": 200, "d": 1}
    made = [r for r in out if r.is_synthetic]
    assert len(out) - len(made) == len(rows) and not any(r.id in (3000, 3001, 4000) for r in made)
    place = {r[0]: np.array(r[2:]) for r in rows if r[2] is not None}
    kind = {r[0]: r[1] for r in rows}
    for r in made[::7]:
        own, at = place[r.id], np.array([r.p, r.q])
        near = sorted((float(((place[o] - own) ** 2).sum()), o) for o in place if o != r.id and kind[o] == r.label and np.isfinite(place[o]).all())[:5]
        # on the segment to one of the five nearest of its class
        along = [(np.dot(at - own, place[o] - own) / d, place[o] - own) for d, o in near]
        assert any(-1e-12 <= t <= 1 + 1e-12 and np.abs(at - own - t * way).max() < 1e-9 for t, way in along)


def test_one_row_is_cut_into_pieces(spark):
    df = spark.createDataFrame([(1, 2500), (2, 1), (3, 0)], "id long, n int")
    got = prep.numbered(df, F.col("n"), 2_000_000, "id").select("id", "j").collect()
    assert sorted(r.j for r in got if r.id == 1) == list(range(1, 2501)) and [r.j for r in got if r.id == 2] == [1]
    assert not any(r.id == 3 for r in got)


@pytest.mark.parametrize("act", [prep.class_weights, lambda df, label: prep.smote(df, ["p"], label, "id")])
def test_rows_without_a_label_are_refused(spark, act):
    df = spark.createDataFrame([(1, 1, 0.5), (2, None, 0.5)], "id int, label int, p double")
    with pytest.raises(ValueError, match="have no label"):
        act(df, "label")
