"""Group fairness of decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.functions.numeric import ratio_or_zero
from leadlake.session import literal_rows

# --- Fixed values: four-fifths rule and equal-opportunity tolerance ----------
DIR_RANGE = (0.80, 1.25)
EOD_LIMIT = 0.10
SENIOR_AGE = 60


def protected_flag(attribute: str) -> Column:
    """1 for the protected group, 0 for everyone else, also where the attribute is missing."""
    if attribute == "age":
        test = F.col("age") >= SENIOR_AGE
    elif attribute == "marital":
        test = F.lower(F.col("marital")) == "single"
    else:
        test = F.col(attribute).cast("int") == 1
    return F.coalesce(test, F.lit(False)).cast("int")


def group_labels(attribute: str) -> tuple[str, str]:
    named = {"age": ("Senior (>=60)", "Non-Senior (<60)"), "marital": ("Single", "Married/Other")}
    return named.get(attribute, ("Protected", "Privileged"))


def _counts(flag: Column, label: str, decision: str) -> dict[str, Column]:
    said, won = F.col(decision) == 1, F.col(label) == 1
    out = {}
    for name, group in (("p", flag == 1), ("u", flag == 0)):
        out[f"{name}_n"] = F.count(F.when(group, 1))
        out[f"{name}_said"] = F.count(F.when(group & said, 1))
        out[f"{name}_won"] = F.count(F.when(group & won, 1))
        out[f"{name}_hit"] = F.count(F.when(group & won & said, 1))
    return out


def _metrics() -> tuple[Column, Column]:
    c = F.col
    favoured = ratio_or_zero(c("p_said"), c("p_n")), ratio_or_zero(c("u_said"), c("u_n"))
    impact = F.when(favoured[1] == 0, 1.0).otherwise(F.round(F.try_divide(*favoured), 4))
    gap = F.round(ratio_or_zero(c("p_hit"), c("p_won")) - ratio_or_zero(c("u_hit"), c("u_won")), 4)
    return impact, gap


def disparate_impact(df: DataFrame, attribute: str, label: str, decision: str) -> DataFrame:
    row = df.agg(*[c.alias(n) for n, c in _counts(protected_flag(attribute), label, decision).items()])
    return row.select(_metrics()[0].alias("disparate_impact_ratio"))


def equal_opportunity(df: DataFrame, attribute: str, label: str, decision: str) -> DataFrame:
    row = df.agg(*[c.alias(n) for n, c in _counts(protected_flag(attribute), label, decision).items()])
    return row.select(_metrics()[1].alias("equal_opportunity_difference"))


def audit(df: DataFrame, attributes: Sequence[str], label: str, decision: str) -> DataFrame:
    """One row per attribute with counts, both metrics and the status. All attributes come from one
    aggregate; an attribute the table lacks is reported as SKIPPED."""
    known = [a for a in attributes if a in df.columns]
    wide = df.agg(*[
        F.struct(*[c.alias(n) for n, c in _counts(protected_flag(a), label, decision).items()]).alias(a) for a in known
    ]) if known else None
    columns = ("attribute", "protected_group", "privileged_group", "protected_count", "privileged_count",
               "disparate_impact_ratio", "equal_opportunity_difference", "four_fifths_passed",
               "equal_opportunity_passed", "status")
    parts = []
    if wide is not None:

        def group_name(side: int) -> Column:
            return F.element_at(
                F.create_map(*[x for a in known for x in (F.lit(a), F.lit(group_labels(a)[side]))]), F.col("attribute"))

        impact, gap = _metrics()
        rows = wide.unpivot([], known, "attribute", "m").select("attribute", "m.*").withColumns({
            "disparate_impact_ratio": impact, "equal_opportunity_difference": gap})
        fair = F.col("disparate_impact_ratio").between(*DIR_RANGE)
        even = F.abs("equal_opportunity_difference") <= EOD_LIMIT
        parts.append(rows.withColumns({
            "protected_group": group_name(0),
            "privileged_group": group_name(1),
            "protected_count": F.col("p_n"), "privileged_count": F.col("u_n"),
            "four_fifths_passed": fair, "equal_opportunity_passed": even,
            "status": F.when(fair & even, "APPROVED").otherwise("REQUIRES_MITIGATION"),
        }).select(*columns))
    skipped = [(a, *([None] * 8), "SKIPPED") for a in attributes if a not in df.columns]
    if skipped:
        ddl = ("attribute string, protected_group string, privileged_group string, protected_count bigint, "
               "privileged_count bigint, disparate_impact_ratio double, equal_opportunity_difference double, "
               "four_fifths_passed boolean, equal_opportunity_passed boolean, status string")
        parts.append(literal_rows(df.sparkSession, ddl, skipped))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
