"""Tiers, actions, economics and routing of scored leads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.config import Economics, Tiers


def priority_tier(probability: Column, tiers: Tiers = Tiers()) -> Column:
    chain = None
    for bound, label in zip(tiers.bounds, tiers.labels):
        test = probability >= F.lit(bound)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.when(probability.isNotNull(), tiers.labels[-1])


def tier_action(tier: Column, tiers: Tiers = Tiers()) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in zip(tiers.labels, tiers.actions) for x in pair])
    return F.try_element_at(pairs, tier)


def recommended(probability: Column, threshold: float) -> Column:
    return (probability >= F.lit(threshold)).cast("int")


def expected_profit(probability: Column, money: Economics = Economics()) -> Column:
    return probability * F.lit(money.deposit_profit) - F.lit(money.call_cost)


def break_even(money: Economics = Economics()) -> Column:
    """The probability at which a call earns exactly its cost."""
    return F.lit(money.call_cost / money.deposit_profit)


def route_mode(df: DataFrame) -> DataFrame:
    """Adds ``mode``: leads without a call so far are scored pre-call, with the duration set to 0."""
    before = F.coalesce(F.col("duration"), F.lit(0.0)) == 0
    return df.withColumns({
        "mode": F.when(before, "pre_call").otherwise("post_call"),
        "duration": F.when(before, 0.0).otherwise(F.col("duration").cast("double")),
    })


def add_decision(df: DataFrame, probability: str, threshold: float, tiers: Tiers = Tiers()) -> DataFrame:
    """Rounded probability, threshold, call flag, tier and action; all decided on the unrounded probability."""
    p = F.col(probability)
    tier = priority_tier(p, tiers)
    return df.withColumns({
        "predicted_conversion_prob": F.round(p, 4),
        "decision_threshold": F.lit(float(threshold)),
        "is_recommended_call": recommended(p, threshold),
        "priority_tier": tier,
        "telesales_action": tier_action(tier, tiers),
    })


def dialer_queue(df: DataFrame, probability: str, key: str) -> DataFrame:
    """All leads, best first. A range sort: every task sorts its own slice."""
    return df.orderBy(F.desc(probability), key)


def top_n(df: DataFrame, score: str, key: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(score), key).limit(n)


def head(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def tail(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(key)).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """A repeatable random sample: the n rows with the smallest hash of (key, seed)."""
    return df.orderBy(F.md5(F.concat_ws("#", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)
