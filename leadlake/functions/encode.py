"""Label and category encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadlake.config import MONTHS


def yes_no_flag(column: Column) -> Column:
    return F.when(column == "yes", 1).when(column == "no", 0)


def target_flag(column: Column) -> Column:
    """1 for yes (also coded 2), 0 for no (also coded 1), NULL for anything else."""
    text = F.lower(F.trim(column.cast("string")))
    return F.when(text.isin("yes", "2"), 1).when(text.isin("no", "1"), 0)


def month_number(column: Column) -> Column:
    """1..12 by position in the calendar list; NULL for other text."""
    months = F.array(*[F.lit(m) for m in MONTHS])
    return F.nullif(F.array_position(months, F.lower(column)).cast("int"), F.lit(0))
