"""Derived lead features: one expression each, shared by batch tables, streams and scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.config import BALANCE_TIERS, LEAD_DEFAULTS, PDAYS_GROUPS, PRESSURE_BUCKETS
from leadlake.functions.text import clean_lead_strings


def _classes(value: Column, steps, first_is_open: bool) -> Column:
    """Labels by ascending upper bound. NULL and NaN belong to no class."""
    known = value.isNotNull() & ~F.isnan(value.cast("double"))
    chain: Column | None = None
    for position, (bound, label) in enumerate(steps):
        if bound is None:
            test = known
        elif position == 0 and first_is_open:
            test = known & (value < F.lit(bound))
        else:
            test = known & (value <= F.lit(bound))
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain


def balance_tier(balance: Column) -> Column:
    return _classes(balance, BALANCE_TIERS, first_is_open=True)


def pdays_group(pdays: Column) -> Column:
    return _classes(pdays, PDAYS_GROUPS, first_is_open=False)


def financial_pressure(default: Column, housing: Column, loan: Column) -> Column:
    def points(flag: Column, weight: int) -> Column:
        return F.when(flag == "yes", weight).otherwise(0)

    return points(default, 2) + points(housing, 1) + points(loan, 1)


def campaign_ratio(campaign: Column, previous: Column) -> Column:
    return F.round(campaign.cast("double") / (previous + 1), 3)


def previously_contacted(pdays: Column) -> Column:
    return F.when(pdays == -1, 0).otherwise(1)


def past_success(poutcome: Column) -> Column:
    return F.when(poutcome == "success", 1).otherwise(0)


def pressure_bucket(campaign: Column) -> Column:
    one, few, many = PRESSURE_BUCKETS
    return F.when(campaign == 1, one).when(campaign.isin(2, 3), few).otherwise(many)


def derived_columns() -> dict[str, Column]:
    c = F.col
    return {
        "balance_tier": balance_tier(c("balance")),
        "pdays_group": pdays_group(c("pdays")),
        "financial_pressure_index": financial_pressure(c("default"), c("housing"), c("loan")),
        "campaign_pressure_ratio": campaign_ratio(c("campaign"), c("previous")),
        "is_previously_contacted": previously_contacted(c("pdays")),
        "past_success_flag": past_success(c("poutcome")),
    }


def fill_lead_defaults(df: DataFrame) -> DataFrame:
    """Defaults for the optional fields of a lead, whether the column or only the value is missing."""
    types = {"duration": "double", "day": "int", "campaign": "int", "pdays": "int", "previous": "int"}
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns
        else F.lit(value).cast(types.get(name, "string"))
        for name, value in LEAD_DEFAULTS.items()
    })


def derive_leads(df: DataFrame) -> DataFrame:
    """Unlabelled leads to model-ready rows: clean, default, derive."""
    filled = fill_lead_defaults(clean_lead_strings(df))
    if "balance" in filled.columns:
        filled = filled.withColumn("balance", F.coalesce(F.col("balance"), F.lit(0.0)))
    return filled.withColumns(derived_columns())
