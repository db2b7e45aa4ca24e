"""The list of registered queries and, where SQL can say it, their oracle texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.plans.fixtures import oracle_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# --- Conformed tables as oracle sub-queries, by another route than the operators (row_number) ----------
_VALID = ("age BETWEEN 18 AND 105 AND duration >= 0 AND campaign >= 1 AND pdays >= -1 AND previous >= 0"
          " AND balance IS NOT NULL")

VIEWS = {
    **oracle_views(),
    "bronze": f"SELECT * FROM leads_dup WHERE {_VALID}",
    "cleaned": """
SELECT trim(customer_id) AS customer_id, age, lower(trim(job)) AS job, lower(trim(marital)) AS marital,
       lower(trim(education)) AS education, lower(trim(in_default)) AS in_default, balance,
       lower(trim(housing)) AS housing, lower(trim(loan)) AS loan, lower(trim(contact)) AS contact, day,
       lower(trim(month)) AS month, duration, campaign, pdays, previous, lower(trim(poutcome)) AS poutcome,
       lower(trim(y)) AS y, src_key, event_ts
FROM bronze""",
    "dim": """
SELECT customer_id, age, job, marital, education, in_default, balance, housing, loan FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_ts DESC, src_key DESC) AS rn FROM cleaned
) WHERE rn = 1""",
    "fact": """
SELECT concat('INT_', sha256(concat_ws('|', customer_id, contact, CAST(day AS VARCHAR), month,
         CAST(CAST(duration AS DECIMAL(38,10)) AS VARCHAR), CAST(campaign AS VARCHAR)))) AS interaction_id,
       customer_id, contact, day, month, duration, campaign, pdays, previous, poutcome, y, event_ts, src_key FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id, contact, day, month, duration, campaign
                               ORDER BY event_ts, src_key) AS rn FROM cleaned
) WHERE rn = 1""",
    "features": """
SELECT f.interaction_id, f.event_ts, f.src_key, d.customer_id, age, job, marital, education, in_default, balance, housing, loan, contact,
       day, month, duration, campaign, pdays, previous, poutcome,
       CASE WHEN balance < 0 THEN 'negative' WHEN balance <= 1000 THEN 'low_0_1k'
            WHEN balance <= 5000 THEN 'mid_1k_5k' ELSE 'high_5k_plus' END AS balance_tier,
       CASE WHEN pdays = -1 THEN 'never' WHEN pdays <= 30 THEN 'recent_le_30d'
            WHEN pdays <= 180 THEN 'mid_31_180d' ELSE 'long_ago_gt_180d' END AS pdays_group,
       CASE WHEN in_default = 'yes' THEN 2 ELSE 0 END + CASE WHEN housing = 'yes' THEN 1 ELSE 0 END
         + CASE WHEN loan = 'yes' THEN 1 ELSE 0 END AS financial_pressure_index,
       round(CAST(campaign AS DOUBLE) / (previous + 1), 3) AS campaign_pressure_ratio,
       CASE WHEN pdays = -1 THEN 0 ELSE 1 END AS is_previously_contacted,
       CASE WHEN poutcome = 'success' THEN 1 ELSE 0 END AS past_success_flag, y
FROM dim d JOIN fact f ON d.customer_id = f.customer_id""",
}

_NEEDS = {
    "leads_dup": ["leads_raw"], "scored": ["leads_raw"], "bronze": ["leads_dup"], "cleaned": ["bronze"],
    "dim": ["cleaned"], "fact": ["cleaned"], "features": ["dim", "fact"],
}


def with_views(text: str, *views: str) -> str:
    """The text with the named sub-queries, and what they rest on, in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in views:
        add(name)
    heads = ", ".join(f"{name} AS ({VIEWS[name].strip()})" for name in order)
    body = text.strip()
    if not heads:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {heads}, {body[5:]}"
    return f"WITH {heads} {body}"


def query(name: str, oracle: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query under its name, with an oracle text when there is one."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_views(oracle, *views)
        return fn

    return register


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Output form: no reserved name, doubles rounded so that the order of summation cannot show."""
    if "default" in df.columns:
        df = df.withColumnRenamed("default", "in_default")
    doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(F.col(c), digits) for c in doubles}) if doubles else df


def load_all() -> None:
    """Import the modules that register queries."""
    from leadlake.plans import (  # noqa: F401
        q_checks, q_columns, q_contracts, q_evaluate, q_models, q_monitor, q_prep, q_profile, q_sources, q_stats, q_streams,
        q_tables,
    )
