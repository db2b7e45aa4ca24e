"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017).

The only labels that count are confirmed toxic texts. All other text is unlabelled: mostly clean, toxic with the class prior.
With P the confirmed and U the unlabelled texts, the risk of clean texts is estimated as E_U[loss(-)] - prior * E_P[loss(-)];
where an over-fitted model drives this estimate below zero, the step goes the other way (the non-negative correction). The
class prior is the toxic share among all labelled rows that may be learned from.

Features of a text are the 5-byte stretches of its lower-cased words that occur in it, word boundaries marked, as 32-bit
hashes; so a stem is known in words never seen. They are found for whole batches at once, by numpy. Of those in the sample, a feature is kept when its rate in P is at least
``LIFT`` times its prior-corrected rate in clean text, and seen in ``LEAST`` texts of P. Each of ``BAGS`` numpy classifiers is
trained in a task of its own on its own sample; the score is the mean of their logits as a probability.

Bounds: a sample holds about ``POSITIVES`` texts of P and ``UNLABELLED`` of U (by hash, over all documents), each text in
it whole; class prior and sample rates are counted over all rows. The model that reaches the tasks has at most as many
features as P's sample. Every document is scored, whole.

NULL, empty and wordless texts have no feature and get the score of the bias. Without a confirmed toxic text nothing can
be learned: all scores are 0. Labels repeated for an id count as toxic if one of them is. Repeated rows and repeated ids enter
a sample once. Extra columns and their names play no part; ids may be NULL (never labelled, not held out).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of one classifier's sample.
POSITIVES, UNLABELLED = 3_000, 9_000
BAGS = 3
LIFT, LEAST = 4.0, 3
#: Bytes of a stretch.
GRAM = 5
EPOCHS, RATE, MOMENTUM = 400, 0.5, 0.9
#: A weight leaves zero only where more texts of P than this pull at it, which chance does not reach.
SHRINK = 3.0
THRESHOLD = 0.3

#: Bytes that are hashed at once.
_PIECE = 1 << 20
#: ASCII that is no letter, digit or underscore ends a word.
_MARK = b"^"
_MARKS = bytes(c if c > 127 or chr(c).isalnum() or chr(c) == "_" else _MARK[0] for c in range(256))


def held_out(key: Column) -> Column:
    """Rows whose labels are for evaluation only."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def hashed(text: bytes) -> np.ndarray:
    """Hash of the stretch at every byte of a marked text that lies in one word, its boundaries included; repeats stay."""
    letters = np.frombuffer(text, dtype=np.uint8)
    size = len(letters) - GRAM + 1
    if size < 1:
        return np.empty(0, np.int32)
    codes = np.zeros(size, dtype=np.uint64)
    for i in range(GRAM):
        codes = (codes << np.uint64(8)) | letters[i:i + size]
    ends = np.concatenate([[0], np.cumsum(letters == _MARK[0])])
    inner = ends[GRAM - 1:GRAM - 1 + size] - ends[1:1 + size]  # marks strictly inside the stretch
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32).view(np.int32)[inner == 0]


def marked(text: str | None) -> bytes:
    return _MARK + (text or "").lower().encode("utf-8", "surrogatepass").translate(_MARKS) + _MARK


def features(text: str | None) -> np.ndarray:
    """Sorted distinct features of a text of any length."""
    whole, found = marked(text), np.empty(0, np.int32)
    for at in range(0, len(whole), _PIECE):
        found = np.union1d(found, hashed(whole[at:at + _PIECE + GRAM - 1]))
    return found.astype(np.int32)


class Scorer:
    """Logits of many texts: one table look-up per byte tells the few stretches that carry a weight."""

    def __init__(self, model: Linear):
        self.model = model
        self.table = np.zeros(1 << 20, dtype=bool)
        self.table[self._slot(model.features)] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return hashes.view(np.uint32) >> np.uint32(12)

    def _present(self, text: bytes) -> np.ndarray:
        found = hashed(text)
        found = np.unique(found[self.table[self._slot(found)]])
        at = np.searchsorted(self.model.features, found)
        at[at == len(self.model.features)] = 0
        return at[self.model.features[at] == found] if len(self.model.features) else np.empty(0, np.int64)

    def logit(self, text: str | None) -> float:
        whole = marked(text)
        places = [self._present(whole[at:at + _PIECE + GRAM - 1]) for at in range(0, len(whole), _PIECE)]
        present = places[0] if len(places) == 1 else np.unique(np.concatenate(places))
        return self.model.bias + float(self.model.weights[present].sum())


@dataclass(frozen=True)
class Linear:
    """Sorted feature hashes, their weights, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def train_one(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Linear:
    """One numpy classifier from feature arrays of P and U."""
    def counted(rows):
        return np.unique(np.concatenate(rows), return_counts=True) if rows else (np.empty(0, np.int32), np.empty(0, np.int64))

    names, in_p = counted(positive)
    names, in_p = names[in_p >= LEAST], in_p[in_p >= LEAST]
    all_u, counts_u = counted(unlabelled)
    at = np.searchsorted(all_u, names)
    at[at == len(all_u)] = 0
    in_u = np.where(all_u[at] == names, counts_u[at], 0) if len(all_u) else np.zeros(len(names))
    rate_p = in_p / max(len(positive), 1)
    rate_u = in_u / max(len(unlabelled), 1)
    clean = np.maximum(rate_u - prior * rate_p, 0.0) / (1.0 - prior)
    names = names[rate_p >= LIFT * np.maximum(clean, 1e-9)]

    def matrix(rows):
        inner = [np.searchsorted(names, np.intersect1d(r, names, assume_unique=True)) for r in rows]
        lengths = np.array([len(r) for r in inner], dtype=np.int64)
        return np.concatenate(inner) if inner else np.empty(0, np.int64), np.repeat(np.arange(len(rows)), lengths)

    (cols_p, rows_p), (cols_u, rows_u) = matrix(positive), matrix(unlabelled)
    n_p, n_u, size = len(positive), max(len(unlabelled), 1), len(names)

    def margins(w, b, cols, rows, n):
        return np.bincount(rows, weights=w[cols], minlength=n)[:n] + b

    def sigmoid(g):
        return 1.0 / (1.0 + np.exp(-np.clip(g, -30, 30)))

    # Plain steps, not normalised ones: a feature moves as far as the texts that hold it agree, so rare ones stay small,
    # and the shrinking takes them back to zero.
    w, b = np.zeros(size), float(np.log(prior / (1.0 - prior)))
    speed, shrink = np.zeros(size + 1), SHRINK * prior / n_p
    for _ in range(EPOCHS):
        g_p, g_u = margins(w, b, cols_p, rows_p, n_p), margins(w, b, cols_u, rows_u, n_u)
        s_p, s_u = sigmoid(g_p), sigmoid(g_u)
        # Logistic losses: softplus(-g) for toxic, softplus(g) for clean.
        negative = np.logaddexp(0.0, g_u).mean() - prior * np.logaddexp(0.0, g_p).mean()
        d_p, d_u = -prior * s_p / n_p, s_u / n_u
        if negative >= 0:
            d_p = d_p - prior * (1.0 - s_p) / n_p
        else:  # the estimated risk of clean texts cannot be negative: step back from what made it so
            d_p, d_u = -d_p, -d_u
        pull = np.bincount(cols_p, weights=d_p[rows_p], minlength=size) + np.bincount(cols_u, weights=d_u[rows_u], minlength=size)
        speed = MOMENTUM * speed - RATE * np.append(pull, d_p.sum() + d_u.sum())
        w, b = w + speed[:-1], b + speed[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - RATE * shrink, 0.0)
    names, w = names[w != 0], w[w != 0]
    return Linear(names, w, float(b))


def _below(columns: list, bag: int, share: float) -> Column:
    """Whether a hash of the columns falls below ``share``: repeats stand or fall together."""
    return F.pmod(F.xxhash64(*columns, F.lit(bag)), F.lit(1 << 40)) < F.lit(int(min(1.0, share) * (1 << 40)))


def _featured(rows: DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in frames:
            part["text"] = [features(t) for t in part["text"]]
            yield part.rename(columns={"text": "found"})

    return rows.mapInPandas(run, "of_p array<int>, of_u array<int>, id_mark long, row_mark long, found array<int>")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> list[Linear]:
    """The classifiers, learned from rows that are not held out."""
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).filter(~held_out(F.col("id")))
    known = labels.select(F.col(key).alias("id"), F.col(label).alias("y")).filter(
        F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    shares = known.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("toxic")).first()
    if not shares.toxic:
        return []
    prior = min(shares.toxic / shares.n, 0.95)
    n_texts = max(texts.count(), 1)

    def of(columns: list, share: float) -> Column:
        return F.array_compact(F.array(*[F.when(_below(columns, bag, share), bag) for bag in range(BAGS)]))

    # At most some BAGS * POSITIVES ids are sent to the documents, whatever their number.
    ids = known.filter(F.col("y") == 1).select("id", of(["id"], POSITIVES / shares.toxic).alias("of_p")).filter(F.size("of_p") > 0)
    sampled = texts.join(F.broadcast(ids), "id", "left").select(
        F.coalesce("of_p", F.array().cast("array<int>")).alias("of_p"), of(["id", "text"], UNLABELLED / n_texts).alias("of_u"),
        F.xxhash64("id").alias("id_mark"), F.xxhash64("id", "text").alias("row_mark"), "text")
    chosen = _featured(sampled.filter((F.size("of_p") > 0) | (F.size("of_u") > 0)))
    # A repeated id counts once among the confirmed, a repeated row once among the unlabelled.
    once = None
    for positive, bags, mark in ((True, "of_p", "id_mark"), (False, "of_u", "row_mark")):
        side = chosen.select(F.explode(bags).alias("bag"), F.lit(positive).alias("positive"), F.col(mark).alias("mark"), "found")
        once = side if once is None else once.unionByName(side)
    once = once.groupBy("bag", "positive", "mark").agg(F.min("found").alias("found"))

    def train(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["positive", "mark"])
        split = [[np.asarray(f, dtype=np.int32) for f in rows.loc[rows["positive"] == side, "found"]] for side in (True, False)]
        model = train_one(*split, prior) if split[0] else Linear(np.empty(0, np.int32), np.empty(0), -30.0)
        return pd.DataFrame({"bag": [key[0]], "features": [model.features], "weights": [model.weights], "bias": [model.bias]})

    found = once.groupBy("bag").applyInPandas(train, "bag int, features array<int>, weights array<double>, bias double").collect()
    return [Linear(np.array(r.features, np.int32), np.array(r.weights), r.bias) for r in sorted(found, key=lambda r: r.bag)]


def combine(models: list[Linear]) -> Linear:
    """The mean of the logits of linear models is a linear model."""
    names = np.unique(np.concatenate([m.features for m in models]))
    weights = np.zeros(len(names))
    for m in models:
        weights[np.searchsorted(names, m.features)] += m.weights / len(models)
    return Linear(names, weights, float(np.mean([m.bias for m in models])))


def score(docs: DataFrame, models: list[Linear], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    rows = docs.select(F.col(key).alias("id"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    decided = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    if not models:
        return rows.select("id", "held_out", F.lit(0.0).alias("score")).select("*", decided)
    model = combine(models)

    @F.pandas_udf("double")
    def chance(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in frames:
            logits = [scorer.logit(t) for t in texts]
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(logits, -40, 40))), dtype="float64")

    return rows.select("id", "held_out", chance("text").alias("score")).select("*", decided)
