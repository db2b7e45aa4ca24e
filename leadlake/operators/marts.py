"""Gold tables: campaign mart, segment mart, feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.functions.features import derived_columns, pressure_bucket
from leadlake.operators.conform import join_dim_fact

FEATURE_COLUMNS = (
    "customer_id", "age", "job", "marital", "education", "default", "balance", "housing", "loan",
    "contact", "day", "month", "duration", "campaign", "pdays", "previous", "poutcome",
    "balance_tier", "pdays_group", "financial_pressure_index", "campaign_pressure_ratio",
    "is_previously_contacted", "past_success_flag", "y",
)


def _converted() -> Column:
    return F.when(F.col("y") == "yes", 1).otherwise(0)


def campaign_performance(fact: DataFrame) -> DataFrame:
    """Calls, mean duration, conversions and rate by month, contact and campaign pressure."""
    calls = fact.withColumn("campaign_pressure_bucket", pressure_bucket(F.col("campaign")))
    return calls.groupBy("month", "contact", "campaign_pressure_bucket").agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.round(F.avg("duration"), 1).alias("avg_duration_seconds"),
        F.sum(_converted()).alias("total_conversions"),
    ).withColumn("conversion_rate", F.round(F.col("total_conversions").cast("double") / F.col("total_calls"), 4))


def campaign_sums(fact: DataFrame, *by: str) -> DataFrame:
    """What the campaign mart is made of, as sums that can be added up over disjoint sets of interactions."""
    calls = fact.withColumn("campaign_pressure_bucket", pressure_bucket(F.col("campaign")))
    return calls.groupBy(*by, "month", "contact", "campaign_pressure_bucket").agg(
        F.count(F.lit(1)).alias("total_calls"), F.sum("duration").alias("seconds"), F.count("duration").alias("timed"),
        F.sum(_converted()).alias("total_conversions"))


def campaign_from_sums(sums: DataFrame) -> DataFrame:
    return sums.groupBy("month", "contact", "campaign_pressure_bucket").agg(
        F.sum("total_calls").alias("total_calls"),
        F.round(F.sum("seconds") / F.sum("timed"), 1).alias("avg_duration_seconds"),
        F.sum("total_conversions").alias("total_conversions"),
    ).withColumn("conversion_rate", F.round(F.col("total_conversions").cast("double") / F.col("total_calls"), 4))


def segment_sums(dim: DataFrame, fact: DataFrame, *by: str) -> DataFrame:
    """What the segment mart is made of. ``by`` names columns of the dimension to keep sums apart."""
    per_customer = fact.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_calls"), F.sum(_converted()).alias("_won"))
    joined = join_dim_fact(dim.select(*by, "customer_id", "job", "education", "housing", "loan", "balance"), per_customer)
    return joined.groupBy(*by, "job", "education", "housing", "loan").agg(
        F.sum("_calls").alias("total_customers"), F.sum(F.col("balance") * F.col("_calls")).alias("balances"),
        F.sum("_won").alias("total_conversions"))


def segment_from_sums(sums: DataFrame) -> DataFrame:
    return sums.groupBy("job", "education", "housing", "loan").agg(
        F.sum("total_customers").alias("total_customers"),
        F.round(F.sum("balances") / F.sum("total_customers"), 2).alias("avg_balance_eur"),
        F.sum("total_conversions").alias("total_conversions"),
    ).withColumn("conversion_rate", F.round(F.col("total_conversions").cast("double") / F.col("total_customers"), 4))


def segment_conversion(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Interactions, mean balance and conversion rate by customer segment.

    The fact is first reduced to two counts per customer. That sum is combined map-side, so a customer
    with a third of all calls reaches the join as one row; the balance is then weighted by the calls.
    """
    per_customer = fact.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_calls"), F.sum(_converted()).alias("_won")
    )
    joined = join_dim_fact(dim.select("customer_id", "job", "education", "housing", "loan", "balance"), per_customer)
    return joined.groupBy("job", "education", "housing", "loan").agg(
        F.sum("_calls").alias("total_customers"),
        F.round(F.sum(F.col("balance") * F.col("_calls")) / F.sum("_calls"), 2).alias("avg_balance_eur"),
        F.sum("_won").alias("total_conversions"),
    ).withColumn("conversion_rate", F.round(F.col("total_conversions").cast("double") / F.col("total_customers"), 4))


def feature_table(dim: DataFrame, fact: DataFrame, extra: tuple[str, ...] = (), counted: DataFrame | None = None) -> DataFrame:
    return join_dim_fact(dim, fact, counted).withColumns(derived_columns()).select(*FEATURE_COLUMNS, *extra)


def sort_mart(mart: DataFrame, measure: str, keys: list[str]) -> DataFrame:
    return mart.orderBy(F.desc(measure), *keys)
