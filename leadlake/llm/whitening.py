"""Whitening of embeddings with covariances by polarisation.

Only squares are ever aggregated: the exact squared centred sum of every dimension and of every sum of two dimensions.
Since Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b), half the difference of these is the covariance, as an exact integer over
n ** 3. The matrix is then handed to ``eigh`` once, and rows are projected where they lie.

Entries become integers x = floor(scale * entry) + shift first, so that sums do not depend on their order. Centring is exact:
tasks subtract the integer m nearest the mean, and the rest r = S - n m is put right afterwards, n^2 sum(y^2) - n r^2 being
the sum of (n x - S)^2 with y = x - m. Squares of y are small; where a batch might leave 64 bits it is computed in
Python's integers.

Three narrow passes over the vectors (sums; squares; projection), each with a map-side result of d or d (d + 1) / 2 numbers a
task; the driver gets such a set once, bounded by the dimension and never by the rows.

Entries must be 64-bit integers once scaled, and sums of squares have at most 38 digits; what is beyond is refused.

Rows without a vector, with an empty one, or with a NULL or non-finite entry are left out. Vectors of different lengths have
no covariance: ValueError. Repeated rows count as often as they occur. No row left: empty result. A component without
variance cannot be whitened: its column is NULL. Columns beside the id and the vector play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
#: Beyond this size of an entry, squares of sums over a batch are taken in Python's integers.
_SMALL = 1 << 20
_BATCH = 1 << 16


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    def broken(v):
        return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))

    return df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(
        F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", broken))


def _integers(vectors: pd.Series, scale: int, shift: int) -> np.ndarray:
    sizes = {len(v) for v in vectors}
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(sizes)[:5]}")
    floors = np.floor(np.stack(vectors.to_numpy()) * scale)
    if np.abs(floors).max(initial=0.0) < 2.0 ** 62:
        return floors.astype(np.int64) + shift
    return np.array([[int(x) + shift for x in row] for row in floors], dtype=object)


def _exact(values: np.ndarray, times: int = 1) -> np.ndarray:
    """The same integers in a type in which ``times`` of their squares, of sums of two, cannot overflow."""
    if values.dtype != object and (values.size == 0 or max(abs(int(values.min())), abs(int(values.max()))) * 2 < _SMALL and times <= _BATCH):
        return values
    return values.astype(object)


def _summed(df: DataFrame, partial) -> dict[int, tuple[int, int]]:
    """Sums of (number, value) rows that tasks give, as {number: (sum, rows)}."""
    schema = "i long, s decimal(38,0), n long"
    found = df.mapInPandas(partial, schema).groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return {r.i: (int(r.s), r.n) for r in found.collect()}


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation. ``squares[i, j]`` is the exact sum of (n x_i - S_i) (n x_j - S_j)."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: int = SCALE
    shift: int = SHIFT

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace > 0 else np.full(len(self.values), np.nan)

    def transform(self, usable_rows: DataFrame) -> DataFrame:
        """(id, deviation, whitened): the exact sum of (n x - S)^2 over the dimensions, and one entry per component."""
        kind = usable_rows.schema["id"].dataType.simpleString()
        n, sums, scale, shift = self.n, self.sums, self.scale, self.shift
        axes = self.vectors
        dead = [not v > 0 for v in self.values]
        roots = np.sqrt(np.where(dead, 1.0, self.values))
        middle = np.array([round(s / n) for s in sums])
        rest = np.array([s - n * int(m) for s, m in zip(sums, middle)])
        rest_squares = sum(int(r) ** 2 for r in rest)

        def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in frames:
                if not len(rows):
                    continue
                x = _integers(rows["v"], scale, shift)
                y = _exact(x - middle, x.shape[1])
                if rest.dtype == object or _SMALL * float(np.abs(rest).max()) * len(rest) > 2.0 ** 62:
                    y = y.astype(object)
                # (n y - r)^2 term by term: the first two sums stay small, n joins in Python's integers.
                deviation = n * n * (y * y).sum(axis=1).astype(object) - 2 * n * (y @ rest).astype(object) + rest_squares
                # x - m is a small integer and r / n below one half: no digit is lost in the difference.
                offsets = (x - middle).astype(np.float64) - np.array([float(r) / n for r in rest])
                white = offsets @ axes / roots
                yield pd.DataFrame({
                    "id": rows["id"].to_numpy(),
                    "deviation": [Decimal(int(d)) for d in deviation],
                    "whitened": [[None if off else float(w) for w, off in zip(line, dead)] for line in white]})

        # The id only passes through: as text, since pandas has no NULL among integers.
        sent = usable_rows.withColumn("id", F.col("id").cast("string"))
        out = sent.mapInPandas(project, "id string, deviation decimal(38,0), whitened array<double>")
        return out.withColumn("id", F.col("id").cast(kind))


def exact_squares(rows: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> tuple[int, list[int], dict[tuple[int, int], int]]:
    """n, the sums, and the exact sum of (n x_i - S_i) (n x_j - S_j) for i <= j, all by polarisation."""

    def sums(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = None, 0
        for part in frames:
            if len(part):
                found = _exact(_integers(part["v"], scale, shift)).sum(axis=0).astype(object)
                if total is not None and len(total) != len(found):
                    raise ValueError(f"vectors of different lengths: {len(total)}, {len(found)}")
                total, n = (found if total is None else total + found), n + len(part)
        if n:
            yield _as_rows(range(len(total)), total, n)

    firsts = _summed(rows, sums)
    if not firsts:
        return 0, [], {}
    dims = max(firsts) + 1
    counts = {n for _, n in firsts.values()}
    if len(counts) > 1:
        raise ValueError("vectors of different lengths")
    n, totals = counts.pop(), [firsts[i][0] for i in range(dims)]
    middle = [round(s / n) for s in totals]

    def squares(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, seen = np.zeros(dims * (dims + 1) // 2 + dims, dtype=object), 0
        for part in frames:
            for at in range(0, len(part), _BATCH):
                y = _integers(part["v"].iloc[at:at + _BATCH], scale, shift) - np.array(middle)
                y = _exact(y, len(y))
                seen += len(y)
                kept[:dims] += (y * y).sum(axis=0).astype(object)
                place = dims
                for i in range(dims - 1):
                    both = y[:, i + 1:] + y[:, i:i + 1]
                    kept[place:place + dims - 1 - i] += (both * both).sum(axis=0).astype(object)
                    place += dims - 1 - i
                kept[place:] += y.sum(axis=0).astype(object)
        if seen:
            yield _as_rows(range(len(kept)), kept, seen)

    seconds = {i: s for i, (s, _) in _summed(rows, squares).items()}
    pairs = dims * (dims - 1) // 2
    rest = [seconds[dims + pairs + i] for i in range(dims)]

    def centred(total: int, r: int) -> int:
        return n * n * total - n * r * r

    own = [centred(seconds[i], rest[i]) for i in range(dims)]
    out, place = {}, dims
    for i in range(dims):
        out[i, i] = own[i]
        for j in range(i + 1, dims):
            out[i, j] = (centred(seconds[place], rest[i] + rest[j]) - own[i] - own[j]) // 2
            place += 1
    return n, totals, out


def _as_rows(numbers: Iterable[int], values: Iterable[int], n: int) -> pd.DataFrame:
    return pd.DataFrame({"i": list(numbers), "s": [Decimal(int(v)) for v in values], "n": n})


def fit(rows: DataFrame, components: int, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """The leading components of the covariance (divisor n); None for no rows."""
    n, sums, squares = exact_squares(rows, scale, shift)
    if n == 0:
        return None
    dims = len(sums)
    covariance = np.zeros((dims, dims))
    for (i, j), total in squares.items():
        covariance[i, j] = covariance[j, i] = total / n ** 3  # true division of integers is correctly rounded
    values, vectors = np.linalg.eigh(covariance)
    # What is left of a component without variance is rounding of the others.
    values = np.where(values <= dims * np.finfo(float).eps * max(values[-1], 0.0), 0.0, values)
    first = np.argsort(-values, kind="stable")[:components]
    return Whitening(n, sums, values[first], vectors[:, first], float(np.trace(covariance)), scale, shift)


def identity_error(transformed: DataFrame, live: list[int]) -> float | None:
    """Largest absolute entry of the covariance of the ``live`` components minus the identity; co-moments are centred."""
    if not live:
        return None
    cell = {c: F.col("whitened")[c] for c in live}
    made = transformed.agg(*[
        F.abs(F.covar_pop(cell[a], cell[b]) - (1.0 if a == b else 0.0)).alias(f"c{a}_{b}")
        for i, a in enumerate(live) for b in live[i:]]).first()
    return max(made)


def whiten(df: DataFrame, key: str, vector: str, components: int = 8) -> DataFrame:
    """One row per usable vector and component: (id, component, n, deviation, whitened, explained, identity_error).

    ``deviation`` is decimal(38,0): beyond some million rows no 64-bit integer holds it."""
    rows = usable(df, key, vector)
    model = fit(rows, components)
    schema = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None:
        return rows.select("id").withColumns({f.split()[0]: F.lit(None).cast(f.split()[1]) for f in schema.split(", ")})
    done = model.transform(rows)
    live = [c for c, v in enumerate(model.values) if v > 0]
    error = identity_error(done, live)
    shares = F.array(*[F.lit(float(s)) for s in model.explained])
    return done.select("id", "deviation", F.posexplode("whitened").alias("_c", "whitened")).select(
        "id", (F.col("_c") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        shares[F.col("_c")].alias("explained"), F.lit(error).cast("double").alias("identity_error"))
