"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.session import shared_dir


def _written(df: DataFrame, purpose: str) -> DataFrame:
    folder = shared_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _least(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Every edge with the least of ``node`` and all its neighbours as ``m``; a join, so that hot nodes can be split."""
    low = edges.groupBy(node).agg(F.min(other).alias("_low"))
    return edges.join(low, node).withColumn("m", F.least(node, "_low")).drop("_low")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the least node reachable over ``edges`` (a, b), for every node that has an edge.

    Each round is written to the shared folder; the loop ends when a round changes nothing. Loops, repeated edges and
    an empty list are fine.
    """
    current = _written(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _least(both, "a", "b").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = _least(large.filter("a > b"), "a", "b")
        moved = small.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = _written(moved.union(small.select("a", F.col("m").alias("b"))).distinct(), "edges")
        row = current.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if (row["n"], row["x"]) == mark:
            break
        mark = (row["n"], row["x"])
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
