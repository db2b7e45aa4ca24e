"""Joins that a hot key cannot hold up.

Adaptive execution splits a large partition only between two plain shuffles; behind an aggregate on the join key it cannot. Here
heavy keys are known before the join: a mergeable frequent-items sketch (one pass over the key, combined before its tiny
shuffle) names every key that fills a partition by itself. Rows of those keys are cut into pieces by a hash of other columns,
and the other side is repeated once a piece for those keys only. All other rows are joined as they are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.session import literal_rows, rank_buckets

#: Counters of the sketch: a key with more than 1 / 7,500 of the rows is always found.
_COUNTERS = 10_000


def heavy_keys(df: DataFrame, key: str, parts: int, most: int = 1_000) -> list[tuple[object, int]]:
    """(key, pieces) of the keys with more rows than one of ``parts`` equal partitions; fewer than ``parts`` of them exist.

    Counts are upper bounds of the sketch, so a key may get a piece too many and none is missed."""
    row = df.select(key).agg(
        F.count(key).alias("n"), F.expr(f"approx_top_k(`{key}`, {min(most, _COUNTERS)}, {_COUNTERS})").alias("top")).first()
    if not row.n:
        return []
    share = row.n / parts
    return [(t["item"], math.ceil(t["count"] / share)) for t in row.top if t["count"] > share]


def join(large: DataFrame, other: DataFrame, key: str, by: Sequence[str], how: str = "inner",
         counted: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """``large`` joined with ``other`` on ``key`` (inner or left), hot keys of ``large`` cut into pieces by the ``by`` columns.

    ``counted`` is where the keys are counted, when ``large`` is dear to compute: any rows with the same heavy keys will do, since
    counts steer balance only. Rows without a key never match and are dealt out as well.
    """
    if how not in ("inner", "left"):
        raise ValueError("a piece of the large side is matched on its own: inner or left join")
    spark = large.sparkSession
    parts = parts or rank_buckets(spark)
    heavy = heavy_keys(large if counted is None else counted, key, parts)
    spread = F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int")
    if not heavy:
        if how == "inner":
            return large.join(other, key, how)
        cut = large.withColumn("_piece", F.when(F.col(key).isNull(), spread).otherwise(F.lit(0)))
        return cut.join(other.withColumn("_piece", F.lit(0)), [key, "_piece"], how).drop("_piece")
    kind = large.schema[key].dataType.simpleString()
    # Fewer rows than partitions: the broadcast is bounded.
    pieces = F.broadcast(literal_rows(spark, f"{key} {kind},_pieces int", heavy))
    of_hot = F.pmod(F.xxhash64(*by), F.col("_pieces")).cast("int")
    cut = large.join(pieces, key, "left").withColumn(
        "_piece", F.when(F.col(key).isNull(), spread).otherwise(F.coalesce(of_hot, F.lit(0)))).drop("_pieces")
    repeated = other.join(pieces, key, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))).drop("_pieces")
    return cut.join(repeated, [key, "_piece"], how).drop("_piece")
