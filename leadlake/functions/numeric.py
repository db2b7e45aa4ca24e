"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def coerce_double(name: str) -> Column:
    """Number or NULL: text that is no number and NaN both become NULL."""
    value = F.col(name).try_cast("double")
    return F.when(~F.isnan(value), value)


def clip(column: Column, low: Column, high: Column) -> Column:
    """``greatest`` and ``least`` skip NULL, so a NULL input is kept by hand."""
    return F.when(column.isNotNull(), F.greatest(F.least(column, high), low))


def band_floor(column: Column, width: float) -> Column:
    """Lower end of the band of the given width; negative values go down, not towards zero."""
    return (F.floor(column / F.lit(float(width))) * F.lit(width)).cast("double")


def within(column: Column, low, high=None) -> Column:
    """Range predicate that is FALSE, never NULL, for missing values."""
    test = column >= F.lit(low) if high is None else column.between(F.lit(low), F.lit(high))
    return F.coalesce(test, F.lit(False))


def member(column: Column, values: Sequence[str]) -> Column:
    return F.coalesce(column.isin(list(values)), F.lit(False))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


#: Edges up to which a comparison tree is generated.
MAX_TREE_EDGES = 32


def bucket_index(column: Column, edges: Sequence[float], closed_left: bool = True) -> Column:
    """How many of the sorted ``edges`` lie at or below (``closed_left``) or strictly below the value.

    Few edges become a balanced tree of CASE branches, all inside codegen. Many would make more code than can be compiled:
    they stay one array literal, searched by halving steps. Both take log2(n) tests per row.
    """
    if len(edges) > MAX_TREE_EDGES:
        table = F.lit([float(e) for e in edges])
        steps = [1 << k for k in reversed(range(len(edges).bit_length()))]

        def halve(at: Column, step: Column) -> Column:
            edge = F.get(table, at + step - 1)  # NULL beyond the last edge: not reached
            return F.when(edge <= column if closed_left else edge < column, at + step).otherwise(at)

        return F.when(column.isNotNull(), F.aggregate(F.lit(steps), F.lit(0), halve))

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        edge = F.lit(float(edges[mid]))
        above = column >= edge if closed_left else column > edge
        return F.when(above, search(mid + 1, hi)).otherwise(search(lo, mid))

    return F.when(column.isNotNull(), search(0, len(edges)))
