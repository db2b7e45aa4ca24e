"""De-identification of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.functions.hashing import token
from leadlake.functions.numeric import band_floor

BAND = 500


def deidentify(df: DataFrame, salt: str, id_column: str = "customer_id", mask_financials: bool = False) -> DataFrame:
    """Ids become keyed tokens that still join; balances are reported in bands when asked for."""
    changes = {}
    if id_column in df.columns:
        changes[id_column] = token(F.col(id_column), salt)
    if mask_financials and "balance" in df.columns:
        changes["balance"] = band_floor(F.col("balance"), BAND)
    return df.withColumns(changes) if changes else df
