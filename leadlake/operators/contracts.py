"""Data contracts: named predicates, evaluated in one pass over the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake import config as cfg
from leadlake.functions.numeric import member, within

REASON = "_quarantine_reason"
SEPARATOR = "; "


@dataclass(frozen=True)
class Rule:
    """``ok`` builds the predicate a good row satisfies; NULL counts as a violation."""

    name: str
    ok: Callable[[], Column]


def in_range(name: str, kind: str, low, high=None) -> Rule:
    return Rule(f"{name}_range", lambda: within(F.col(name).try_cast(kind), low, high))


def in_domain(name: str, values: Sequence[str]) -> Rule:
    return Rule(f"{name}_domain", lambda: member(F.col(name), values))


def is_number(name: str) -> Rule:
    def ok() -> Column:
        value = F.col(name).try_cast("double")
        return value.isNotNull() & ~F.isnan(value)

    return Rule(f"{name}_number", ok)


def present(name: str) -> Rule:
    return Rule(f"{name}_present", lambda: F.col(name).isNotNull())


def bronze_rules(limits: cfg.Contracts = cfg.Contracts()) -> list[Rule]:
    return [
        in_range("age", "int", limits.min_age, limits.max_age),
        is_number("balance"),
        in_range("duration", "double", 0),
        in_range("campaign", "int", 1),
        in_range("pdays", "int", -1),
        in_range("previous", "int", 0),
    ]


def customer_rules(limits: cfg.Contracts = cfg.Contracts()) -> list[Rule]:
    return [
        present("customer_id"),
        in_range("age", "int", limits.min_age, limits.max_age),
        in_domain("job", cfg.JOBS),
        in_domain("marital", cfg.MARITALS),
        in_domain("education", cfg.EDUCATIONS),
        in_domain("default", cfg.YES_NO),
        is_number("balance"),
        in_domain("housing", cfg.YES_NO),
        in_domain("loan", cfg.YES_NO),
    ]


def interaction_rules() -> list[Rule]:
    return [
        present("interaction_id"),
        present("customer_id"),
        in_domain("contact", cfg.CONTACTS),
        in_range("day", "int", 1, 31),
        in_domain("month", cfg.MONTHS),
        in_range("duration", "double", 0),
        in_range("campaign", "int", 1),
        in_range("pdays", "int", -1),
        in_range("previous", "int", 0),
        in_domain("poutcome", cfg.POUTCOMES),
    ]


def lead_rules(limits: cfg.Contracts = cfg.Contracts()) -> list[Rule]:
    """Scoring request: required fields present, numbers in range. Run it after the defaults are filled."""
    return [
        in_range("age", "int", limits.min_age, limits.max_age),
        *[present(c) for c in ("job", "marital", "education", "default", "housing", "loan")],
        is_number("balance"),
        in_range("day", "int", 1, 31),
        in_range("duration", "double", 0),
        in_range("campaign", "int", 1),
        in_range("pdays", "int", -1),
        in_range("previous", "int", 0),
    ]


def feedback_rules() -> list[Rule]:
    return [present("customer_id"), in_range("call_duration", "int", 0), in_domain("outcome", cfg.OUTCOMES)]


def require_columns(df: DataFrame, columns: Sequence[str] = cfg.BRONZE_REQUIRED) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing mandatory columns: {missing}")


def reason(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules as one text, empty for a good row. ``concat_ws`` skips the NULLs."""
    return F.concat_ws(SEPARATOR, *[F.when(~F.coalesce(r.ok(), F.lit(False)), r.name) for r in rules])


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn(REASON, reason(rules))


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine); together they hold every input row exactly once."""
    checked = check(df, rules)
    return checked.filter(F.col(REASON) == "").drop(REASON), checked.filter(F.col(REASON) != "")


def violation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, violations) for every rule, also those never broken, from one aggregate."""
    broken = [
        F.count(F.when(~F.coalesce(r.ok(), F.lit(False)), 1)).alias(r.name) for r in rules
    ]
    totals = df.agg(*broken)
    return totals.unpivot([], [r.name for r in rules], "rule", "violations")


def unique_violations(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs more than once.

    The repeated keys are counted with map-side combine and joined back, so that a hot key is never
    gathered in one task; adaptive execution splits the join when one key dominates.
    """
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key)
    return df.join(repeated, key, "left_semi")


def unique_violation_count(df: DataFrame, key: str) -> DataFrame:
    """(rule, violations): number of rows with a repeated key, without a join."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.lit(f"{key}_unique").alias("rule"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("violations"),
    )


def quarantine_ratio(df: DataFrame, rules: Sequence[Rule], limits: cfg.Contracts = cfg.Contracts()) -> DataFrame:
    """One row: rows, quarantined, ratio and whether the ratio is within the limit."""
    counts = check(df, rules).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(F.when(F.col(REASON) != "", 1)).alias("quarantined_rows"),
    )
    ratio = F.coalesce(F.try_divide(F.col("quarantined_rows").cast("double"), F.col("total_rows")), F.lit(0.0))
    return counts.withColumn("quarantine_ratio", ratio).withColumn(
        "within_limit", F.col("quarantine_ratio") <= F.lit(limits.max_quarantine_ratio)
    )


class QuarantineLimitExceeded(ValueError):
    """Too large a share of a batch broke its contract."""


def enforce_ratio(total: int, quarantined: int, limits: cfg.Contracts = cfg.Contracts()) -> None:
    if total and quarantined / total > limits.max_quarantine_ratio:
        raise QuarantineLimitExceeded(f"{quarantined} of {total} rows broke the contract")
