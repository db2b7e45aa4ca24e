"""Properties that hold for any input, and brute-force comparisons on small random inputs."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadlake.operators import bins, contracts, drift, evaluate, profile, ranks, stats

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
numbers = st.floats(min_value=-1e4, max_value=1e4, allow_nan=False).map(lambda v: round(v, 1))
samples = st.lists(numbers, min_size=2, max_size=40)
labelled = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 12).map(lambda v: v / 12)), min_size=2, max_size=40)


def column(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "k int, v double")


@FEW
@given(samples)
def test_quantiles_equal_numpy(spark, values):
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = ranks.quantile_values(column(spark, values), ["v"], shares)["v"]
    assert got == pytest.approx(list(np.percentile(values, [100 * s for s in shares])), abs=1e-6)


@FEW
@given(samples)
def test_quantile_bins_cover_every_row(spark, values):
    df = column(spark, values)
    edges = bins.quantile_edges(df, "v", 5)
    got = [r.b for r in df.select(bins.quantile_bin(F.col("v"), edges).alias("b")).collect()]
    assert all(0 <= b <= max(0, len(edges) - 2) for b in got)


@FEW
@given(samples)
def test_rank_first_bins_are_even(spark, values):
    rows = bins.rank_first_bins(column(spark, values), "v", "k", 4).groupBy("bin").count().collect()
    assert sum(r["count"] for r in rows) == len(values)
    if len(values) >= 8:
        assert max(r["count"] for r in rows) - min(r["count"] for r in rows) <= 2


@FEW
@given(samples)
def test_histogram_equals_numpy(spark, values):
    rows = sorted(profile.histogram(column(spark, values), "v", bins=7).collect(), key=lambda r: r.bin)
    assert sum(r.n for r in rows) == len(values) and len(rows) == 7


@FEW
@given(samples)
def test_psi_of_equal_samples_is_zero(spark, values):
    df = column(spark, values)
    assert [r.psi for r in drift.psi_by_feature(df, df, ["v"]).collect()] == [0.0]


@FEW
@given(samples, samples)
def test_psi_equals_numpy(spark, base, incoming):
    ends = np.percentile(base, np.linspace(0, 100, 11))
    ends[0], ends[-1] = -np.inf, np.inf
    ends = np.unique(np.round(ends, 9))
    e, a = (np.histogram(np.round(v, 9), bins=ends)[0] / len(v) for v in (base, incoming))
    e, a = (np.clip(v, 1e-4, None) for v in (e, a))
    e, a = e / e.sum(), a / a.sum()
    got = drift.psi_by_feature(column(spark, base), column(spark, incoming), ["v"]).first().psi
    assert got == pytest.approx(float(np.sum((a - e) * np.log(a / e))), abs=2e-4)


@FEW
@given(labelled)
def test_curve_equals_counting_at_each_threshold(spark, rows):
    df = spark.createDataFrame(rows, "label int, score double")
    for r in evaluate.threshold_curve(df).collect():
        calls = [y for y, s in rows if s >= r.threshold]
        assert (r.calls, r.conversions) == (len(calls), sum(calls))
        assert r.net_profit == sum(calls) * 150.0 - len(calls) * 5.0


@FEW
@given(labelled)
def test_auc_equals_counting_pairs(spark, rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    got = evaluate.roc_auc(spark.createDataFrame(rows, "label int, score double")).first().roc_auc
    if not pos or not neg:
        assert got is None
    else:
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert got == pytest.approx(want)


@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 120)), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=30))
def test_valid_and_quarantine_are_a_partition(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k int, age int, duration int")
    valid, bad = contracts.split(df, [contracts.in_range("age", "int", 18, 105), contracts.in_range("duration", "double", 0)])
    v, b = {r.k for r in valid.collect()}, {r.k for r in bad.collect()}
    assert v | b == set(range(len(rows))) and not v & b


def test_a_value_with_half_of_all_rows(spark):
    """One value, one customer and one class dominate; results stay exact."""
    rng = np.random.default_rng(5)
    values = np.concatenate([np.full(5000, 3.0), rng.normal(0, 10, 5000)])
    labels = (np.arange(10000) % 10 == 0).astype(int)
    df = spark.createDataFrame([(i, float(v), int(y)) for i, (v, y) in enumerate(zip(values, labels))], "k int, v double, label int")
    got = ranks.quantile_values(df, ["v"], [0.1, 0.5, 0.9])["v"]
    assert got == pytest.approx(list(np.percentile(values, [10, 50, 90])), abs=1e-9)
    a, b = values[labels == 0], values[labels == 1]
    u = sum(np.sum(x > b) + 0.5 * np.sum(x == b) for x in a)
    assert stats.mann_whitney(df, ["v"], "label").first().u == pytest.approx(u)
    sizes = [r["count"] for r in bins.rank_first_bins(df, "v", "k", 10).groupBy("bin").count().collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1


def test_mutual_information_of_a_copy_is_its_entropy(spark):
    df = spark.createDataFrame([(str(i % 2), i % 2) for i in range(100)], "c string, label int")
    assert stats.mutual_information(df, ["c"], "label").first().mi == pytest.approx(math.log(2))


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_score_areas_do_not_depend_on_partitioning(spark, sf, parts):
    from leadlake.plans import fixtures as fx

    df = fx.scored(spark, sf)
    want = evaluate.evaluate(df, 0.45).first()
    got = evaluate.evaluate(df.repartition(parts), 0.45).first()
    assert [round(x, 9) for x in got] == [round(x, 9) for x in want]
