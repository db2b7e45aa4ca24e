"""Toxicity, Merkle manifest and whitening against plain versions; NULL, empty, tied, repeated and long rows."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlake.llm import merkle, registry, toxicity, whitening

# --- Merkle manifest -----------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp string, place int, digest string, key string, total long"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def hexed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """Root, and each node's siblings in order, by building all levels."""
    paths, level, owner = [[] for _ in nodes], list(nodes), [[i] for i in range(len(nodes))]
    while len(level) > 1:
        up, owners = [], []
        for at in range(0, len(level), 8):
            run = level[at:at + 8]
            for i in range(len(run)):
                for leaf in owner[at + i]:
                    paths[leaf].append(("".join(run[:i]), "".join(run[i + 1:])))
            up.append(hexed(*run))
            owners.append([x for o in owner[at:at + 8] for x in o])
        level, owner = up, owners
    return level[0], paths


def plain_manifest(rows):
    """Multiset of (doc_id, leaf, subroot, root, proof)."""
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    groups = collections.defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = hexed(*map(field, (doc_id, source, lang, n_chars, text)))
        groups[lang].append((doc_id is not None, doc_id or 0, leaf, doc_id))
    subs = {}
    for lang, leaves in groups.items():
        leaves.sort(key=lambda x: x[:3])
        subs[lang] = plain_tree([x[2] for x in leaves])
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    root, tops = plain_tree([subs[x][0] for x in order])
    out = collections.Counter()
    for lang, top in zip(order, tops):
        for leaf, path in zip(groups[lang], subs[lang][1]):
            out[leaf[3], leaf[2], subs[lang][0], root, hexed(*[a + b for a, b in [*path, *top]])] += 1
    return out


def manifest(spark, rows, changed=None):
    docs = spark.createDataFrame([(*r, "g", 1, "d", "k", 9) for r in rows], DOCS)
    return merkle.verify(merkle.leaves(docs, COLUMNS, "lang", "doc_id", changed))


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513])
def test_manifest_equals_the_plain_tree(spark, n):
    rows = [(i * 7 % n, f"text {i}", "en", "s", i) for i in range(n)]
    got = collections.Counter((r.key, r.digest, r.subroot, r.root, r.proof) for r in manifest(spark, rows).collect())
    assert got == plain_manifest(rows)


def test_manifest_over_several_blocks_and_odd_rows(spark):
    """One language beyond two blocks with a third of all rows alike, NULLs everywhere, a language of one, long texts."""
    same = (5, "copy", "en", "s", 4)
    rows = [*[(i, f"t{i}", "en", None, i) for i in range(6000)], *[same] * 3000, (None, None, None, None, None), (None, "", None, "s", 0),
            (1, "é😀", "é", "s", 2), (2 ** 62 + 1, "x" * 200_000, "de", "s", 1), (2 ** 62, None, "de", "", -3), (7, "a", "de", "s", 1), (7, "b", "de", "s", 1)]
    found = manifest(spark, rows).collect()
    assert collections.Counter((r.key, r.digest, r.subroot, r.root, r.proof) for r in found) == plain_manifest(rows)
    assert len({r.root for r in found}) == 1 and all(r.folded == r.root for r in found)
    assert max(r.place for r in found) == 8999 and {r.total for r in found if r.grp == "+en"} == {9000}


def test_manifest_tells_changed_rows(spark):
    rows = [(i, f"Text {i}" if i % 2 else f"text {i}", "en", "s", i) for i in range(100)]
    changed = F.when(F.col("doc_id") % 5 == 0, merkle.leaf_digest([*[F.col(c) for c in COLUMNS[:-1]], F.lower("text")]))
    for r in manifest(spark, rows, changed).collect():
        assert (r.folded == r.root) == (r.key % 5 != 0 or r.key % 2 == 0)


def test_witnesses_lead_to_the_root(spark):
    rows = [(i, str(i), "en" if i % 3 else None, "s", i) for i in range(300)]
    docs = spark.createDataFrame([(*r, "g", 1, "d", "k", 9) for r in rows], DOCS)
    for r in merkle.witnesses(merkle.leaves(docs, COLUMNS, "lang", "doc_id")).collect():
        path = [(w.left, w.right) for w in r.witness]
        assert merkle.fold(r.digest, path) == r.root and merkle.fold("0" * 64, path) != r.root


def test_manifest_of_nothing(spark):
    assert manifest(spark, []).count() == 0


def test_appends_extend_earlier_witnesses():
    tree = merkle.Appender(20)
    for i in range(3):
        tree.append(hexed(str(i)))
    assert tree.right[0] == [[hexed("1"), hexed("2")], [hexed("2")], []]
    tree.append(hexed("3"))
    assert tree.right[0][0] == [hexed("1"), hexed("2"), hexed("3")] and tree.left[0][3] == hexed("0") + hexed("1") + hexed("2")


# --- Whitening -----------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, id string, v int, whitened int, component int, n int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "i", 1, 2, 3, 4) for i, v in rows], VECTORS)


def plain_whitening(rows, k):
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] for v in rows], dtype=object)
    n = len(x)
    d = n * x - x.sum(0)
    cov = np.array([[int(a) / n ** 3 for a in line] for line in d.T @ d])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return (d * d).sum(1), (d.astype(float) / n) @ axes / np.sqrt(values), values / np.trace(cov)


def test_whitening_equals_the_plain_version(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(12, 12))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(700, 12)) @ mix)]
    rows += [(700 + i, rows[0][1]) for i in range(300)]
    broken = [(2001, None), (2002, [1.0] * 11 + [None]), (2003, [float("nan")] + [1.0] * 11), (2004, [float("-inf")] * 12), (2005, [])]
    got = whitening.whiten(vectors(spark, rows + broken), "vec_id", "embedding", 8).toPandas()
    assert len(got) == 8 * len(rows) and set(got["n"]) == {len(rows)}
    deviation, white, share = plain_whitening([v for _, v in rows], 8)
    wide = got.pivot(index="id", columns="component", values="whitened").to_numpy()
    for c in range(8):
        sign = np.sign((wide[:, c] * white[:, c]).sum())
        assert np.abs(sign * wide[:, c] - white[:, c]).max() < 1e-9
    assert [int(x) for x in got[got.component == 1].sort_values("id")["deviation"]] == [int(x) for x in deviation]
    assert np.allclose(got[got["id"] == 0].sort_values("component")["explained"], share, rtol=1e-9)
    assert got["identity_error"].max() < 1e-9 and got["identity_error"].nunique() == 1


def test_covariances_are_exact_integers(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(40, 5)) * [1, 1e3, 1e5, 1, 1e-3])]
    n, sums, squares = whitening.exact_squares(whitening.usable(vectors(spark, rows), "vec_id", "embedding"))
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] for _, v in rows]
    assert n == 40 and sums == [sum(c) for c in zip(*x)]
    for (i, j), total in squares.items():
        assert total == sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x)


def test_whitening_without_variance_or_rows(spark):
    one = whitening.whiten(vectors(spark, [(1, [1.0, 2.0, 3.0])]), "vec_id", "embedding", 2).collect()
    assert [(r.id, r.component, r.n, int(r.deviation), r.whitened) for r in one] == [(1, 1, 1, 0, None), (1, 2, 1, 0, None)]
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 2.0]) for i in range(9)]), "vec_id", "embedding", 2).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in flat) and flat[0].identity_error < 1e-12
    assert whitening.whiten(vectors(spark, []), "vec_id", "embedding").count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])]), "vec_id", "embedding").count() == 0
    with pytest.raises(Exception, match="different lengths"):
        whitening.whiten(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]), "vec_id", "embedding").count()


def test_whitening_query(spark, sf):
    got = registry.op13_embedding_whitening(spark, sf).toPandas()
    assert list(got.columns[:7]) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert (got["deviation"].astype(object) == got["deviation_exact"].astype(object).map(int)).all() and got["identity_error"].iloc[0] < 1e-4


# --- Toxicity ------------------------------------------------------------------------------

TOXIC = "doc_id long, text string, id string, score double, toxic int, of_p string, found string"


def corpus(rng, n):
    words = ["".join(rng.choice(list("abdeghilnorstu"), rng.integers(3, 9))) for _ in range(600)]
    bad = ["zorgel", "quimbat", "vlaskend"]
    out, labels = [], []
    for i in range(n):
        text = list(rng.choice(words, rng.integers(20, 120)))
        toxic = int(rng.random() < 0.15)
        if toxic:
            for _ in range(3):
                text.insert(int(rng.integers(0, len(text))), str(rng.choice(bad)) + str(rng.choice(["", "a", "en", "ish"])))
        out.append((i, " ".join(text)))
        if rng.random() < 0.5:
            labels.append((i, toxic))
    return out, labels


def scored(spark, docs, labels):
    rows = spark.createDataFrame([(i, t, "i", 0.5, 1, "p", "f") for i, t in docs], TOXIC)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    return {(r.id, i): r for i, r in enumerate(toxicity.score(rows, toxicity.fit(rows, known)).collect())}.values()


def test_toxicity_on_held_out_rows(spark):
    docs, labels = corpus(np.random.default_rng(2), 2500)
    known = dict(labels)
    odd = [(None, None), (None, "zorgel quimbat vlaskend"), (5000, ""), (5001, None), (5002, "  \n "), (5003, "zorgel vlaskenden " * 30_000)]
    rows = list(scored(spark, docs + odd + [docs[1]] * 1000, labels + [(1, 0)] * 50 + [(None, 1), (9, None)]))
    assert len(rows) == len(docs) + len(odd) + 1000
    held = [r for r in rows if r.held_out and r.id in known]
    assert all(zlib.crc32(str(r.id).encode()) % 4 == 2 for r in held) and len(held) > 200
    right = sum(r.predicted == known[r.id] for r in held) / len(held)
    caught = [r.predicted for r in held if known[r.id] == 1]
    assert right > 0.95 and sum(caught) > 0.9 * len(caught)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    by_id = {r.id: r for r in rows}
    assert by_id[5000].score == by_id[5001].score == by_id[5002].score < 0.3 and by_id[5003].predicted == 1


def test_held_out_labels_do_not_count(spark):
    docs, labels = corpus(np.random.default_rng(4), 600)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    assert sorted((r.id, r.score) for r in scored(spark, docs, labels)) == sorted((r.id, r.score) for r in scored(spark, docs, turned))


def test_toxicity_without_examples(spark):
    assert [(r.score, r.predicted) for r in scored(spark, [(1, "a b"), (2, None)], [(1, 0)])] == [(0.0, 0)] * 2
    assert list(scored(spark, [], [])) == []


def test_features_of_pieces_equal_those_of_the_whole(monkeypatch):
    text = " ".join(f"Wort{i}é, naïve-x_{i % 7}" for i in range(400)) + "\U0001f600"
    whole = toxicity.features(text)
    model = toxicity.Linear(whole[::3].copy(), np.linspace(-1, 1, len(whole[::3])), 0.5)
    logit = toxicity.Scorer(model).logit(text)
    assert abs(logit - 0.5 - model.weights.sum()) < 1e-9
    monkeypatch.setattr(toxicity, "_PIECE", 64)
    assert (toxicity.features(text) == whole).all() and abs(toxicity.Scorer(model).logit(text) - logit) < 1e-9


def test_non_negative_step_keeps_an_overfitted_model_from_running_away():
    rng = np.random.default_rng(1)
    few = [np.unique(rng.integers(0, 60, 12)).astype(np.int32) for _ in range(20)]
    model = toxicity.train_one(few, few[:10], 0.4)
    assert np.isfinite(model.weights).all() and np.abs(model.weights).max(initial=0.0) < 20 and np.isfinite(model.bias)
