"""Models, attribution, registry, scoring."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlake.config import Settings, Training
from leadlake.operators import explain, registry, train
from leadlake.operators.evaluate import roc_auc
from leadlake.operators.prep import assign_split
from leadlake.plans import fixtures as fx
from leadlake.plans import lakehouse
from leadlake.plans.q_tables import ORDER, features
from leadlake.session import shared_dir

QUICK = Settings(training=Training(gbt_trees=5, gbt_step=0.3, gbt_depth=3))


@pytest.fixture(scope="module")
def table(spark, sf):
    path = shared_dir(spark, "features")
    features(spark, sf).drop(*ORDER).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def linear(table):
    return train.train_model(table, "post_call", train.LOGISTIC, QUICK)


@pytest.fixture(scope="module")
def trees(table):
    return train.train_model(table, "post_call", train.TREES, QUICK)


@pytest.fixture(scope="module")
def held_out(table):
    return assign_split(train.labelled(table), "customer_id").filter("split = 'test'")


@pytest.mark.parametrize("kind", ["linear", "trees"])
def test_scores_are_useful_probabilities(request, held_out, kind):
    model = request.getfixturevalue(kind)
    scored = train.add_probability(model.model, held_out, "score")
    ends = scored.agg(F.min("score"), F.max("score")).first()
    assert 0.0 <= ends[0] <= ends[1] <= 1.0
    assert roc_auc(scored).first().roc_auc > 0.6  # the outcome depends on the duration
    assert 0.05 <= model.threshold <= 0.95
    assert set(model.metrics) >= {"roc_auc", "pr_auc", "f1_score", "tp", "fn"}


def test_fit_on_oversampled_rows_needs_no_weights(table, held_out):
    rows = assign_split(train.labelled(table), "customer_id").filter("split = 'train'")
    model = train.fit_oversampled(rows, "post_call", "interaction_id", settings=QUICK)
    assert len(model.background) == len(model.feature_names)
    assert roc_auc(train.add_probability(model.model, held_out, "score")).first().roc_auc > 0.6


@pytest.mark.parametrize("kind", ["linear", "trees"])
def test_explained_scores_hold_in_one_row(request, spark, sf, kind):
    model = request.getfixturevalue(kind)
    leads = fx.leads_raw(spark, sf).drop("y", "event_ts")
    plain = {r.src_key: r for r in lakehouse.batch_score(leads, model).collect()}
    rows = lakehouse.batch_score(leads, model, explain=True).collect()
    assert len(rows) == len(plain)
    for r in rows:
        assert sum(r.attributions) + r.base_margin == pytest.approx(r.margin, abs=1e-6)
        assert r.probability_yes == pytest.approx(plain[r.src_key].probability_yes, abs=1e-12) and r.decision_threshold == model.threshold
        assert [d.impact for d in r.positive_drivers] == sorted((d.impact for d in r.positive_drivers), reverse=True)
    target = f"{shared_dir(spark, 'scored')}.parquet"
    source = f"{shared_dir(spark, 'leads')}.parquet"
    leads.limit(20).write.parquet(source)
    lakehouse.score_file(spark, source, target, model, explain=True)
    assert all(r.positive_drivers.startswith("[") for r in spark.read.parquet(target).collect())


def test_pre_call_model_does_not_see_the_duration(table):
    model = train.train_model(table, "pre_call", train.LOGISTIC, QUICK)
    assert "duration" not in model.feature_names
    assert len(model.feature_names) == len(model.background)


def test_modes_fitted_side_by_side_equal_a_fit_alone(table, linear):
    models = train.train_models(table, lakehouse.MODES, train.LOGISTIC, QUICK)
    assert list(models) == list(lakehouse.MODES) and all(models[m].mode == m for m in models)
    assert models["post_call"].threshold == linear.threshold and models["post_call"].feature_names == linear.feature_names
    assert models["post_call"].metrics["roc_auc"] == pytest.approx(linear.metrics["roc_auc"], abs=1e-9)
    assert train.train_models(table, [], train.LOGISTIC, QUICK) == {}


def test_training_and_held_rows_are_computed_once(table, linear, monkeypatch):
    """Weights, scales, levels and the encoding read kept training rows; threshold and evaluation read kept scores."""
    seen, cached = [], lambda df: "InMemoryRelation" in df._jdf.queryExecution().withCachedData().toString()

    def watched(name):
        plain = getattr(train, name)
        monkeypatch.setattr(train, name, lambda df, *a, **k: (seen.append((name, cached(df))), plain(df, *a, **k))[1])

    for name in ("add_class_weight", "encoding_stages", "threshold_curve", "evaluate"):
        watched(name)
    model = train.train_model(table, "post_call", train.LOGISTIC, QUICK)
    assert seen == [(name, True) for name in ("add_class_weight", "encoding_stages", "threshold_curve", "evaluate")]
    assert model.metrics == pytest.approx(linear.metrics, abs=1e-9) and model.threshold == linear.threshold


def test_unknown_kinds_are_refused(table):
    with pytest.raises(ValueError):
        train.train_model(table, "post_call", "forest", QUICK)
    with pytest.raises(ValueError):
        train.train_model(table, "mid_call", train.LOGISTIC, QUICK)


def test_linear_attribution_adds_up_and_matches_the_definition(linear, held_out):
    rows = explain.linear_attributions(linear, held_out).limit(50).collect()
    for r in rows:
        assert sum(r.attributions) + r.base_margin == pytest.approx(r.margin, abs=1e-9)


def test_tree_attribution_adds_up(trees, held_out):
    rows = explain.tree_attributions(trees, held_out, "interaction_id").collect()
    assert len(rows) == held_out.count()
    for r in rows:
        assert sum(r.attributions) + r.base_margin == pytest.approx(r.margin, abs=1e-6)


def by_definition(row, paths):
    """Shapley values coalition by coalition."""
    players = sorted({c[0] for _, conditions in paths for c in conditions})

    def worth(known):
        return sum(v * np.prod([(float(lo < row[f] <= hi) if f in known else share) for f, share, lo, hi in conditions])
                   for v, conditions in paths)

    phi = np.zeros(len(row))
    for p in players:
        others = [q for q in players if q != p]
        for size in range(len(players)):
            for group in combinations(others, size):
                weight = factorial(size) * factorial(len(players) - size - 1) / factorial(len(players))
                phi[p] += weight * (worth({*group, p}) - worth(set(group)))
    return phi


def test_tree_attribution_equals_the_definition():
    rng = np.random.default_rng(1)
    nodes = {0: {
        0: (0.0, 100.0, 1, 2, 0, (-np.inf, 0.5)), 1: (0.0, 40.0, 3, 4, 1, (-np.inf, 0.2)), 2: (0.0, 60.0, 5, 6, 0, (-np.inf, 0.8)),
        3: (1.0, 10.0, -1, -1, -1, None), 4: (-2.0, 30.0, -1, -1, -1, None), 5: (0.5, 20.0, 7, 8, 2, (0.5, np.inf)),
        6: (4.0, 40.0, -1, -1, -1, None), 7: (3.0, 5.0, -1, -1, -1, None), 8: (-1.0, 15.0, -1, -1, -1, None)}}
    paths = explain._tree_paths(nodes, [0.7])
    x = rng.uniform(0, 1, (20, 4))
    got = explain._tree_shap(x, paths)
    for row, phi in zip(x, got):
        assert phi == pytest.approx(by_definition(row, paths), abs=1e-12)


def test_tree_paths_reproduce_the_model(spark, trees, held_out):
    paths = explain._tree_paths(explain._tree_nodes(spark, trees.classifier), trees.classifier.treeWeights)
    rows = train.add_probability(trees.model, held_out, "p").limit(1).collect()
    vector = trees.model.transform(held_out.limit(1)).select("features", "probability").first()
    x = vector.features.toArray()
    raw = sum(v * all(lo < x[f] <= hi for f, _, lo, hi in conditions) for v, conditions in paths)
    assert 1 / (1 + np.exp(-2 * raw)) == pytest.approx(vector.probability[1], abs=1e-9)
    assert rows


def test_drivers_are_signed_and_sorted(trees, held_out):
    rows = explain.top_drivers(explain.tree_attributions(trees, held_out, "interaction_id"), trees.feature_names, 3).collect()
    for r in rows:
        up, down = [d.impact for d in r.positive_drivers], [d.impact for d in r.negative_drivers]
        assert len(up) <= 3 and len(down) <= 3
        assert all(v > 0 for v in up) and all(v < 0 for v in down)
        assert up == sorted(up, reverse=True) and down == sorted(down)


def test_global_importance_names_the_driver_of_the_outcome(trees, held_out):
    top = explain.global_importance(explain.tree_attributions(trees, held_out, "interaction_id"), trees.feature_names, 5).collect()
    assert top[0].feature == "duration" and len(top) == 5


def test_registry_round_trip(spark, linear, held_out):
    root = shared_dir(spark, "registry")
    assert not registry.is_model_available(spark, root, "post_call")
    with pytest.raises(FileNotFoundError):
        registry.load_active_model(spark, root, "post_call")
    registry.save_model(spark, linear, root, "v1", [{"feature": "duration", "importance": 1.0}])
    loaded = registry.load_active_model(spark, root, "post_call")
    assert (loaded.threshold, loaded.feature_names, loaded.mode) == (linear.threshold, linear.feature_names, "post_call")
    a = train.add_probability(linear.model, held_out, "a").select("interaction_id", "a")
    b = train.add_probability(loaded.model, held_out, "b").select("interaction_id", "b")
    assert a.join(b, "interaction_id").filter(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0
    assert not registry.is_model_available(spark, root, "pre_call")


def test_coefficients_are_named_and_sorted(linear, trees):
    weights = [w for _, w in train.coefficients(linear)]
    assert weights == sorted(weights, reverse=True) and len(weights) == len(linear.feature_names)
    with pytest.raises(ValueError):
        train.coefficients(trees)


def test_batch_scoring_keeps_every_lead_and_its_decision(spark, sf, linear):
    leads = fx.leads_raw(spark, sf).drop("y", "event_ts")
    rows = lakehouse.batch_score(leads, linear).collect()
    assert len(rows) == leads.count()
    p = [r.predicted_conversion_prob for r in rows]
    assert p == sorted(p, reverse=True)
    for r in rows:
        assert r.is_recommended_call == int(r.probability_yes >= linear.threshold)
        assert r.priority_tier.startswith("Tier 1") == (r.probability_yes >= 0.7)


def test_unseen_category_is_scored(spark, sf, linear):
    odd = fx.leads_raw(spark, sf).drop("y", "event_ts").withColumn("job", F.lit("astronaut"))
    assert lakehouse.batch_score(odd, linear).filter("probability_yes IS NULL").count() == 0


def test_daily_run_reports_both_modes(spark, sf):
    layers = lakehouse.Layers(shared_dir(spark, "daily"))
    rows = lakehouse.run_daily(fx.leads_dup(spark, sf), layers, "b1", "salt", train.LOGISTIC, ORDER, QUICK).collect()
    assert {r.mode for r in rows} == {"pre_call", "post_call"}
    assert all(r.deidentified_tokens == r.silver_customers and r.feature_records == r.silver_interactions for r in rows)


def random_tree(rng, depth, features):
    """Nodes of a full tree in the form that is read back from a saved one; features meet again on the way down."""
    nodes = {}

    def grow(left, cover):
        here = len(nodes)
        nodes[here] = (float(rng.normal()), cover, -1, -1, -1, None)
        if left:
            share, at = float(rng.uniform(0.2, 0.8)), (-np.inf, float(np.round(rng.normal(), 1)))
            nodes[here] = (0.0, cover, grow(left - 1, cover * share), grow(left - 1, cover * (1 - share)), int(rng.integers(features)), at)
        return here

    grow(depth, 1000.0)
    return nodes


def test_looked_up_attributions_equal_those_leaf_by_leaf():
    rng = np.random.default_rng(5)
    trees = {0: random_tree(rng, 11, 12), 1: random_tree(rng, 0, 12), **{t: random_tree(rng, 5, 12) for t in range(2, 12)}}
    paths = explain._tree_paths(trees, [0.3] * len(trees))
    tables = explain.leaf_tables(paths)
    shallow = [p for p in paths if len(p[1]) <= 5]
    assert tables.paths and len(explain.leaf_tables(shallow).groups) * 2 < len(shallow)  # deep leaves stay paths, others share tables
    x = np.round(rng.normal(size=(400, 12)), 1)  # many values lie on a threshold
    assert np.abs(explain._table_shap(x, tables) - explain._tree_shap(x, paths)).max() < 1e-12


def test_drivers_by_rounded_strength_then_name(spark):
    rng = np.random.default_rng(6)
    names = [f"f{i:02d}" for i in rng.permutation(40)]
    rows = [[float(v) for v in np.round(rng.normal(size=40), 3) + rng.integers(-1, 2, 40) * 4e-5] for _ in range(60)]
    rows += [[0.0] * 40, [4e-5] * 40, [-0.5] * 40, [1e-3, *[0.0] * 39], [None, *[2.0] * 39]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id long, attributions array<double>")
    for k in (1, 3, 50):
        for r in explain.top_drivers(df, names, k).collect():
            shown = [(float(f"{v:.4f}"), n) for v, n in zip(rows[r.id], names) if v is not None]
            for sign, got in ((1, r.positive_drivers), (-1, r.negative_drivers)):
                want = sorted((-v * sign, n) for v, n in shown if v * sign > 0)[:k]
                assert [(d.impact, d.feature) for d in got] == [(-v * sign, n) for v, n in want]
    plan = explain.top_drivers(df, names)._jdf.queryExecution().optimizedPlan().toString()
    assert "_pairs" in plan and "_ordered" in plan  # computed once, not once per list and entry


# --- Boosted trees ------------------------------------------------------------------------

def encoded_rows(spark, rows, parts=4):
    """Rows (numbers, codes, label, weight) with the metadata that the assembler writes."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    n, m = len(rows[0][0]), len(rows[0][1])
    flat = [(*map(float, x), *map(str, c), int(y), float(w)) for x, c, y, w in rows]
    ddl = ", ".join([*(f"x{i} double" for i in range(n)), *(f"c{i} string" for i in range(m)), "label int", "weight double"])
    df = spark.createDataFrame(flat, ddl).repartition(parts)
    encoder = Pipeline(stages=[
        StringIndexer(inputCols=[f"c{i}" for i in range(m)], outputCols=[f"i{i}" for i in range(m)], stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"i{i}" for i in range(m)], outputCols=[f"o{i}" for i in range(m)], dropLast=True),
        VectorAssembler(inputCols=[*(f"x{i}" for i in range(n)), *(f"o{i}" for i in range(m))], outputCol="features")]).fit(df)
    levels = [len(v) for v in encoder.stages[0].labelsArray]
    path = shared_dir(spark, "encoded")
    encoder.transform(df).select("features", "label", "weight").write.parquet(path)
    return spark.read.parquet(path), n, levels


def sample_rows(n, seed, weights=(0.7, 1.9)):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 5, n), np.where(rng.random(n) < 0.7, 0.0, rng.normal(size=n)), np.full(n, 2.0)], axis=1)
    c = np.stack([rng.integers(0, 12, n), rng.integers(0, 2, n), rng.integers(0, 4, n)], axis=1)
    y = (x[:, 0] + 0.4 * x[:, 1] + (c[:, 0] % 3) - c[:, 1] + rng.normal(size=n) > 1.5).astype(int)
    return [(a, b, v, weights[v]) for a, b, v in zip(x, c, y)]


@pytest.mark.parametrize("n", [700, 13_000])  # the second takes its candidate splits from a sample of the rows
def test_boosted_trees_score_as_those_of_spark(spark, monkeypatch, n):
    """Equal scores of the rows they were fitted on. Where two splits part these rows alike, rounding may pick either."""
    from pyspark.ml.functions import vector_to_array

    from leadlake.operators import boost

    monkeypatch.setattr(boost, "_CHECKPOINT", 3)
    df, numbers, levels = encoded_rows(spark, sample_rows(n, n))
    estimator = train.classifier(train.TREES, 1.0, Settings(training=Training(gbt_trees=8, gbt_step=0.3, gbt_depth=4)))
    theirs, ours = estimator.fit(df), boost.fit_trees(df, numbers, levels, estimator)
    assert ours.treeWeights == theirs.treeWeights and ours.numFeatures == theirs.numFeatures and ours.getMaxDepth() == 4
    both = theirs.transform(df).select("features", vector_to_array("rawPrediction")[1].alias("a"))
    both = ours.transform(both).select("a", vector_to_array("rawPrediction")[1].alias("b"))
    assert both.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-8


def test_boosted_trees_do_not_depend_on_the_order_of_rows(spark):
    from leadlake.operators import boost

    rows = sample_rows(900, 5)
    estimator = train.classifier(train.TREES, 1.0, QUICK)
    shown = {boost.fit_trees(df, numbers, levels, estimator).toDebugString.split("\n", 1)[1]
             for df, numbers, levels in (encoded_rows(spark, rows, 1), encoded_rows(spark, rows[::-1], 7))}
    assert len(shown) == 1


def test_boosted_trees_of_one_class_or_equal_rows_are_leaves(spark):
    from leadlake.operators import boost

    estimator = train.classifier(train.TREES, 1.0, QUICK)
    for rows in ([(a, b, 1, 1.0) for a, b, _, _ in sample_rows(40, 1)], [((1.0,), (0,), i % 2, 1.0) for i in range(10)], sample_rows(1, 2)):
        df, numbers, levels = encoded_rows(spark, rows)
        model = boost.fit_trees(df, numbers, levels, estimator)
        assert model.totalNumNodes == 5
    with pytest.raises(ValueError):
        boost.fit_trees(df.limit(0), numbers, levels, estimator)
    with pytest.raises(ValueError):
        boost.fit_trees(df.withColumn("label", F.lit(2)), numbers, levels, estimator)


def test_train_model_grows_its_trees_from_histograms(table, monkeypatch):
    from pyspark.ml.classification import GBTClassifier

    monkeypatch.setattr(GBTClassifier, "_fit", lambda *a: pytest.fail("a pass over whole vectors for each level"))
    parts = assign_split(train.labelled(table), "customer_id").filter("split = 'train'")
    assert train.fit_model(parts, "post_call", train.TREES, QUICK).classifier.getNumTrees == 5


def test_trees_score_by_batches_as_the_pipeline_does(trees, held_out):
    from pyspark.errors import PythonException
    from pyspark.ml.functions import vector_to_array

    rows = held_out.withColumn("job", F.when(F.col("age") % 2 == 0, F.lit("never seen")).otherwise(F.col("job")))
    theirs = trees.model.transform(rows).select("interaction_id", vector_to_array("probability")[1].alias("a"))
    scored = train.add_probability(trees.model, rows, "b")
    assert scored.columns == [*rows.columns, "b"]
    assert "UDF(UDF(" not in scored._jdf.queryExecution().optimizedPlan().toString()  # no vectors, and each row meets the trees once
    both = scored.join(theirs, "interaction_id")
    assert both.count() == rows.count() and both.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-12
    assert train.add_probability(trees.model, rows.limit(0), "b").count() == 0
    with pytest.raises(PythonException, match="missing"):
        train.add_probability(trees.model, rows.withColumn("age", F.lit(None).cast("int")), "b").collect()
