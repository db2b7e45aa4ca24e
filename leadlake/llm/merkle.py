"""Merkle manifest of a table, with a witness of every row.

Leaves of one group (a language) are put in order and appended to a tree of fan 8. The append is incremental: a node that
joins an open run of siblings is given the siblings before it and is itself added to the partial witness of each of them;
when a run is full, or the input ends, it closes and its digest is appended one level up. Appends are aligned: every task
takes one block of 8 ** 4 consecutive leaves, so all runs inside a block close there, and its root is the only thing that
goes on. Block roots are appended in the same way, tier by tier, then the roots of the groups. Going back down, each
block gets the witness of its root and every leaf the witness of its block behind its own.

No group of rows is larger than a block, whatever one language holds: places come from a range sort over all groups, and
only bounded things leave the tasks (a block root per 4,096 leaves). The driver learns one number a tier, the size of the
largest group. Sorted leaves (about 100 bytes each, never texts) and block roots are written to the shared folder.

NULL in a hashed column is ``-`` in the leaf; NULL groups and NULL order keys come first. Rows with the same order key are
ordered by their leaf, so equal rows get neighbouring places. An empty table has no rows and no root. Only the named
columns are read; further ones, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.session import rank_buckets, shared_dir

FAN = 8
#: Levels that close inside one block, and the leaves of a block.
LEVELS = 4
SPAN = FAN ** LEVELS

_SIDES = "array<struct<left: string, right: string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 over the columns, each as its byte length, a colon and its text, or ``-`` for NULL."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


class Appender:
    """Aligned append of digests. ``levels`` closes exactly so many levels; None closes until one node is left."""

    def __init__(self, total: int, levels: int | None = None):
        if levels is None:
            levels, left = 0, total
            while left > 1:
                levels, left = levels + 1, -(-left // FAN)
        self.levels = levels
        self.open: list[list[str]] = [[] for _ in range(levels + 1)]
        #: Per level, of every node appended there: siblings on the left, and on the right as far as known.
        self.left: list[list[str]] = [[] for _ in range(levels)]
        self.right: list[list[list[str]]] = [[] for _ in range(levels)]

    def append(self, node: str, level: int = 0) -> None:
        run = self.open[level]
        if level < self.levels:
            self.left[level].append("".join(run))
            for witness in self.right[level][len(self.right[level]) - len(run):]:
                witness.append(node)
            self.right[level].append([])
        run.append(node)
        if len(run) == FAN and level < self.levels:
            self._close(level)

    def _close(self, level: int) -> None:
        parent = digest("".join(self.open[level]))
        self.open[level] = []
        self.append(parent, level + 1)

    def finish(self) -> str:
        for level in range(self.levels):
            if self.open[level]:
                self._close(level)
        return self.open[self.levels][0]

    def witness(self, place: int) -> list[tuple[str, str]]:
        """Siblings left and right of the node at ``place``, level by level."""
        out = []
        for level in range(self.levels):
            out.append((self.left[level][place], "".join(self.right[level][place])))
            place //= FAN
        return out


def fold(node: str, witness: Sequence[tuple[str, str]]) -> str:
    """The root that a node and its witness lead to."""
    for left, right in witness:
        node = digest(left + node + right)
    return node


def proof(witness: Sequence[tuple[str, str]]) -> str:
    return digest("".join(left + right for left, right in witness))


def _appended(rows: pd.DataFrame) -> tuple[pd.DataFrame, Appender]:
    rows = rows.sort_values("place", kind="stable")
    total = int(rows["total"].iloc[0])
    tree = Appender(total, LEVELS if total > SPAN else None)
    for node in rows["digest"]:
        tree.append(node)
    return rows, tree


def _roots(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    _, tree = _appended(rows)
    return pd.DataFrame({"grp": [key[0]], "place": [key[1]], "digest": [tree.finish()], "total": [-(-int(rows["total"].iloc[0]) // SPAN)]})


def _places(items: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``place`` (0, 1, ... in ``order`` within the group) and ``total``, by a range sort of all groups at once.

    The sorted rows are written, since the limits of a range sort are sampled anew whenever it runs again. The running
    number of equal rows tells them apart, so that no range grows by repeats of one row.
    """
    spark = items.sparkSession
    numbered = items.withColumn("_copy", F.monotonically_increasing_id())
    keys = [F.col(group), *[F.col(c) for c in order], F.col("_copy")]
    ordered = numbered.repartitionByRange(rank_buckets(spark), *keys).sortWithinPartitions(*keys).drop("_copy")
    folder = shared_dir(spark, "merkle-leaves")
    ordered.withColumn("_at", F.monotonically_increasing_id()).write.parquet(folder)
    placed = spark.read.parquet(folder).withColumn("_piece", F.shiftright("_at", 33))
    starts = placed.groupBy(group, "_piece").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    line = Window.partitionBy(group).orderBy("_piece")
    before = F.sum("_n").over(line.rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.select(
        group, "_piece", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(group)).alias("total"))
    return placed.join(starts, [group, "_piece"]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_piece", "_shift")


def _block() -> Column:
    return F.floor(F.col("place") / SPAN).cast("long").alias("block")


def _climb(items: DataFrame, top: bool) -> DataFrame | None:
    """(grp, block, above, subroot, root) of every block of ``items`` (grp, place, digest, total): the witness of the block's
    root, from the tiers over it. ``top`` marks the tree over the groups' roots. None where there is no item."""
    spark = items.sparkSession
    schema = "grp string, place long, digest string, total long"
    folder = shared_dir(spark, "merkle-roots")
    items.select("grp", "place", "digest", "total").groupBy("grp", _block()).applyInPandas(_roots, schema).write.parquet(folder)
    roots = spark.read.schema(schema).parquet(folder)
    largest = roots.agg(F.max("total").alias("n")).first().n
    if largest is None:
        return None
    if largest > 1:
        return _down(roots, _climb(roots, top)).select(
            "grp", F.col("place").alias("block"), F.col("witness").alias("above"), "subroot", "root")
    if top:
        return roots.select("grp", F.col("place").alias("block"), F.array().cast(_SIDES).alias("above"),
                            F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    subroots = _places(roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"), "grp", ["name"])
    over = _down(subroots, _climb(subroots, True))
    return over.select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("block"), F.col("witness").alias("above"),
                       F.col("digest").alias("subroot"), "root")


def _down(items: DataFrame, blocks: DataFrame, fields: str = f"witness {_SIDES}", emit=None) -> DataFrame:
    """``items`` with the witness up to the root, block by block: siblings inside the block, then those of the block.

    ``emit(rows, paths)`` adds columns ``fields`` made from the witnesses, where these themselves are not wanted.
    """
    names = [f.name for f in items.schema]

    def attach(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, tree = _appended(rows)
        tree.finish()
        rest = [(s["left"], s["right"]) for s in above["above"].iloc[0]]
        rows = rows[names].copy()
        paths = ([*tree.witness(i), *rest] for i in range(len(rows)))
        if emit is None:
            rows["witness"] = [[{"left": a, "right": b} for a, b in path] for path in paths]
        else:
            emit(rows, paths)
        rows["subroot"], rows["root"] = above["subroot"].iloc[0], above["root"].iloc[0]
        return rows

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return items.groupBy("grp", _block()).cogroup(blocks.groupBy("grp", "block")).applyInPandas(
        attach, f"{schema}, {fields}, subroot string, root string")


def leaves(df: DataFrame, columns: Sequence[str], group: str, order: str, changed: Column | None = None) -> DataFrame:
    """One row per row of ``df``: (grp, key, digest, changed). ``changed`` is the leaf of an altered row, NULL where none is."""
    name = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))  # NULL is before every text
    return df.select(
        name.alias("grp"), F.col(order).alias("key"), leaf_digest([F.col(c) for c in columns]).alias("digest"),
        (F.lit(None).cast("string") if changed is None else changed).alias("changed"))


def _all(items: DataFrame, **how) -> DataFrame:
    kind = items.schema["key"].dataType
    # Behind the sort the key only passes through pandas, which has no NULL among integers: it goes as text.
    placed = _places(items, "grp", ["key", "digest"]).withColumn("key", F.col("key").cast("string"))
    blocks = _climb(placed, False)
    if blocks is None:
        blocks = items.sparkSession.createDataFrame([], f"grp string, block long, above {_SIDES}, subroot string, root string")
    return _down(placed, blocks, **how).withColumn("key", F.col("key").cast(kind))


def witnesses(items: DataFrame) -> DataFrame:
    """Leaves with ``place``, ``total``, ``witness`` (siblings left and right, level by level), ``subroot`` and ``root``."""
    return _all(items)


def verify(items: DataFrame) -> DataFrame:
    """Leaves with ``place``, ``total``, ``proof`` (digest of the witness), ``folded`` (the root that the changed leaf, or else
    the leaf, leads to), ``subroot`` and ``root``. Witnesses are folded where they are made and never moved."""

    def folded(rows: pd.DataFrame, paths: Iterable[list[tuple[str, str]]]) -> None:
        now = rows["changed"].where(rows["changed"].notna(), rows["digest"])
        out = [(proof(path), fold(node, path)) for node, path in zip(now, paths)]
        rows["proof"], rows["folded"] = [p for p, _ in out], [r for _, r in out]

    return _all(items, fields="proof string, folded string", emit=folded)
