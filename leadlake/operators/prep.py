"""Preparation: winsorising, encoding, scaling, splitting, weighting, oversampling.

``fit`` steps bring a bounded number of scalars (per column, per level) to the driver; applying them is
a narrow projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.config import Features, Split
from leadlake.functions.hashing import hash_fraction
from leadlake.functions.numeric import clip
from leadlake.operators.neighbours import CELL_ROWS, nearest_neighbours
from leadlake.operators.profile import missing_counts
from leadlake.operators.ranks import hash_ranks, quantile_values


def winsorise(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    ends = quantile_values(df, columns, (low, high))
    return df.withColumns({
        c: clip(F.col(c).cast("double"), F.lit(ends[c][0]), F.lit(ends[c][1])) for c in columns if ends[c]
    })


def category_levels(df: DataFrame, columns: Sequence[str], max_levels: int = 1000) -> dict[str, list[str]]:
    """Sorted levels per column. A column with more levels than a one-hot block can hold is refused, not cut."""
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    wide = [c for c in columns if sizes[c] > max_levels]
    if wide:
        raise ValueError(f"too many levels to encode: {wide}")
    row = df.agg(*[F.sort_array(F.collect_set(F.col(c).cast("string"))).alias(c) for c in columns]).first()
    return {c: list(row[c]) for c in columns}


def one_hot_drop_first(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """0/1 columns ``<column>_<level>`` for all levels but the first, which is the baseline."""
    flags = {
        f"{c}_{level}": F.coalesce((F.col(c) == level).cast("int"), F.lit(0))
        for c, values in levels.items() for level in values[1:]
    }
    return df.withColumns(flags).drop(*levels)


def one_hot(column: Column, levels: Sequence[str]) -> Column:
    """0/1 array over all sorted levels; a level not seen when fitting gives all zeros."""
    return F.array(*[F.coalesce((column == level).cast("int"), F.lit(0)) for level in levels])


@dataclass(frozen=True)
class Scaler:
    """Mean and population standard deviation per column; a constant column is only centred."""

    mean: Mapping[str, float]
    std: Mapping[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> "Scaler":
        row = df.agg(*[
            F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns
        ]).first()
        return cls({c: row[c]["m"] or 0.0 for c in columns}, {c: row[c]["s"] or 1.0 for c in columns})

    def column(self, name: str) -> Column:
        return (F.col(name).cast("double") - F.lit(self.mean[name])) / F.lit(self.std[name])

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.column(c) for c in self.mean})


def model_columns(mode: str, features: Features = Features()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) inputs; the call duration is unknown before a call, so pre-call leaves it out."""
    if mode not in ("pre_call", "post_call"):
        raise ValueError(f"unknown mode {mode!r}")
    numeric = [c for c in features.numerical if mode == "post_call" or c != "duration"]
    return numeric, [*features.categorical, *features.binary]


@dataclass(frozen=True)
class Encoder:
    """Scaled numbers followed by one-hot blocks, as one array column, with the names of its entries."""

    scaler: Scaler
    levels: Mapping[str, Sequence[str]]

    @classmethod
    def fit(cls, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> "Encoder":
        return cls(Scaler.fit(df, numeric), category_levels(df, categorical))

    @property
    def names(self) -> list[str]:
        return [*self.scaler.mean, *[f"{c}_{level}" for c, values in self.levels.items() for level in values]]

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        numbers = F.array(*[self.scaler.column(c) for c in self.scaler.mean])
        blocks = [one_hot(F.col(c).cast("string"), v).cast("array<double>") for c, v in self.levels.items()]
        return df.withColumn(output, F.concat(numbers, *blocks))


def assign_split(df: DataFrame, key: str, ratios: Split = Split()) -> DataFrame:
    """Adds ``split``: train, validation or test by a hash of ``key``. All rows of a key stay together, the
    result does not depend on partitioning, and no row moves."""
    u = hash_fraction(F.col(key), ratios.seed)
    label = F.when(u < ratios.test, "test").when(u < ratios.test + ratios.validation, "validation").otherwise("train")
    return df.withColumn("split", label)


def assign_split_exact(df: DataFrame, key: str, label: str, ratios: Split = Split()) -> DataFrame:
    """Row split with exact class shares: the hash rank inside each class is cut at the ratios."""
    ranked = hash_ranks(df, key, [label], ratios.seed)
    test = F.round(F.col("group_n") * F.lit(ratios.test))
    held = F.round(F.col("group_n") * F.lit(ratios.test + ratios.validation))
    name = F.when(F.col("hash_rank") <= test, "test").when(F.col("hash_rank") <= held, "validation").otherwise("train")
    return ranked.withColumn("split", name).drop("hash_rank", "group_n")


def class_counts(df: DataFrame, label: str, max_classes: int = 1000) -> dict:
    """Rows of each class. Rows without a label, or more classes than a label can have, are refused."""
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"{label} has over {max_classes} values: it is no class label")
    counts = {r[label]: r["n"] for r in rows}
    if None in counts:
        raise ValueError(f"{counts[None]} rows have no {label}")
    return counts


def class_weights(df: DataFrame, label: str) -> dict[int, float]:
    """n / (classes * n_class) for each class."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    return {k: total / (len(counts) * n) for k, n in counts.items()}


def add_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    chain = None
    for value, weight in sorted(class_weights(df, label).items()):
        test = F.col(label) == value
        chain = F.when(test, weight) if chain is None else chain.when(test, weight)
    return df.withColumn(name, chain)


def null_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total number of missing cells and whether the table is free of them."""
    total = missing_counts(df, columns).agg(F.sum("n").alias("missing_cells"))
    return total.withColumn("is_clean", F.col("missing_cells") == 0)


# --- Oversampling -------------------------------------------------------------

_PIECE = 1000


def numbered(df: DataFrame, count: Column, most: int, by: str, name: str = "j") -> DataFrame:
    """``count`` copies of each row (``most`` at most), numbered from 1. Numbers are dealt out in steps of a thousand, and
    dealt to other tasks in between, so that neither an array nor a task is as large as the share of one row."""
    steps, size = 1, _PIECE
    while size < most:
        steps, size = steps + 1, size * _PIECE
    out = df.withColumns({"_from": F.lit(1).cast("long"), "_to": count.cast("long")}).filter(F.col("_to") > 0)
    for step in range(steps - 1, -1, -1):
        width = F.lit(_PIECE ** step)
        out = out.withColumn("_at", F.explode(F.sequence(F.col("_from"), F.col("_to"), width)))
        out = out.withColumns({"_from": F.col("_at"), "_to": F.least(F.col("_at") + width - 1, F.col("_to"))})
        if step:
            out = out.repartition(by, "_at")
    return out.withColumnRenamed("_from", name).drop("_to", "_at")


def smote(df: DataFrame, columns: Sequence[str], label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Input rows plus synthetic rows until every class is as large as the largest, in named columns; see ``smote_points``."""
    points = df.select(key, label, F.array(*[F.col(c).cast("double") for c in columns]).alias("_x"))
    out = smote_points(points, "_x", label, key, k, seed)
    return out.select(key, label, *[F.col("_x")[i].alias(c) for i, c in enumerate(columns)], "is_synthetic")


def smote_points(df: DataFrame, x: str, label: str, key: str, k: int = 5, seed: int = 42, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(key, label, x, is_synthetic): rows of (key, label, x array) plus synthetic ones until every class is as large as the largest.

    Each synthetic row lies between a row and one of its ``k`` nearest rows of the same class (exact, ties by a hash of the
    key). How many a row yields follows from its hash rank, so the totals are exact; which neighbour and how far along
    follow from hashes, so a re-run gives the same rows. Rows with a missing coordinate are kept but yield nothing; a class with
    fewer than two complete rows stays as it is; rows without a label are refused.
    """
    counts = class_counts(df, label)
    originals = df.select(key, label, x, F.lit(0).alias("is_synthetic"))
    if not counts:
        return originals
    complete = originals.filter(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))))
    usable = class_counts(complete, label)
    out, largest = originals, max(counts.values())
    for value in sorted(counts, key=str):
        wanted, n = largest - counts[value], usable.get(value, 0)
        if wanted > 0 and n > 1:
            rows = complete.filter(F.col(label) == F.lit(value)).select(F.col(key).alias("id"), F.col(x).alias("x"), F.col(label).alias("_label"))
            made = _synthetic(rows, k, seed, wanted, n, cell_rows)
            out = out.unionByName(made.select(
                F.col("id").alias(key), F.col("_label").alias(label), F.col("_new").alias(x), F.lit(1).alias("is_synthetic")))
    return out


def _synthetic(rows: DataFrame, k: int, seed: int, wanted: int, n: int, cell_rows: int) -> DataFrame:
    """(id, _label, _new): ``wanted`` new points of one class of ``n`` rows (id, x, _label)."""
    ranks = hash_ranks(rows.select("id", "_label"), "id", ["_label"], seed).select("id", "hash_rank", "_label")
    near = nearest_neighbours(rows.select("id", "x"), k, cell_rows)
    each, rest = divmod(wanted, n)
    share = F.lit(each) + (F.col("hash_rank") <= rest).cast("int")

    def unit(salt: int) -> Column:
        return F.pmod(F.xxhash64("id", "j", F.lit(seed + salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))

    return (
        numbered(near.join(ranks, "id"), share, each + 1, "id")
        .withColumn("_pick", (F.floor(unit(1) * F.size("neighbours")) + 1).cast("int"))
        .withColumn("_to", F.element_at("neighbours", F.col("_pick"))["x"])
        .withColumn("_t", unit(2))
        .withColumn("_new", F.zip_with("x", "_to", lambda a, b: a + (b - a) * F.col("_t")))
    )
