"""Settings as frozen dataclasses plus the fixed domain values of the contracts."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field, fields, replace

# --- Fixed values: contract domains -----------------------------------------
JOBS = (
    "admin.", "blue-collar", "entrepreneur", "housemaid", "management", "retired",
    "self-employed", "services", "student", "technician", "unemployed", "unknown",
)
MARITALS = ("married", "single", "divorced")
EDUCATIONS = ("primary", "secondary", "tertiary", "unknown")
YES_NO = ("yes", "no")
CONTACTS = ("cellular", "telephone", "unknown")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
POUTCOMES = ("unknown", "failure", "other", "success")
OUTCOMES = ("agreed", "declined", "callback", "unreachable")

# --- Fixed values: column groups --------------------------------------------
LEAD_STRINGS = ("job", "marital", "education", "default", "housing", "loan", "contact", "month", "poutcome")
CUSTOMER_COLUMNS = ("age", "job", "marital", "education", "default", "balance", "housing", "loan")
INTERACTION_KEY = ("customer_id", "contact", "day", "month", "duration", "campaign")
INTERACTION_COLUMNS = ("contact", "day", "month", "duration", "campaign", "pdays", "previous", "poutcome", "y")
BRONZE_REQUIRED = ("age", "balance", "duration", "campaign", "pdays", "previous")
ID_COLUMNS = ("customer_id", "interaction_id", "feedback_id", "agent_id")

# --- Fixed values: defaults of an incoming lead -----------------------------
LEAD_DEFAULTS = {
    "customer_id": "ANONYMOUS", "contact": "unknown", "day": 15, "month": "may", "duration": 0.0,
    "campaign": 1, "pdays": -1, "previous": 0, "poutcome": "unknown",
}

# --- Fixed values: class labels of derived features -------------------------
BALANCE_TIERS = ((0.0, "negative"), (1000.0, "low_0_1k"), (5000.0, "mid_1k_5k"), (None, "high_5k_plus"))
PDAYS_GROUPS = ((-1, "never"), (30, "recent_le_30d"), (180, "mid_31_180d"), (None, "long_ago_gt_180d"))
PRESSURE_BUCKETS = ("1 call", "2-3 calls", "4+ calls")

TIER_LABELS = (
    "Tier 1 (Hot - Priority Dispatch)",
    "Tier 2 (Warm - Follow Up)",
    "Tier 3 (Neutral - Low Priority)",
    "Tier 4 (Cold - Do Not Call)",
)
TIER_ACTIONS = (
    "Send to a senior agent now; call within 30 minutes; offer the preferred rate",
    "Assign to the standard team; call at lunch time or after 17:00",
    "Send an SMS or e-mail first; call only when the link is opened",
    "Leave out of this campaign to save calling cost",
)

# --- Fixed values: latency buckets, drift features --------------------------
LATENCY_BUCKETS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5)
DRIFT_FEATURES = ("age", "balance", "day", "campaign")


# --- Fixed values: limits, money, tier bounds, model columns, split and training defaults ----
@dataclass(frozen=True)
class Contracts:
    min_age: int = 18
    max_age: int = 105
    write_quarantine: bool = True
    enforce_ratio: bool = False
    max_quarantine_ratio: float = 0.10


@dataclass(frozen=True)
class Economics:
    deposit_profit: float = 150.0
    call_cost: float = 5.0


@dataclass(frozen=True)
class Tiers:
    """Lower probability bounds of tiers 1 to 3; everything below is tier 4."""

    bounds: tuple[float, float, float] = (0.70, 0.45, 0.25)
    labels: tuple[str, ...] = TIER_LABELS
    actions: tuple[str, ...] = TIER_ACTIONS


@dataclass(frozen=True)
class Features:
    numerical: tuple[str, ...] = (
        "age", "balance", "day", "duration", "campaign", "pdays", "previous",
        "financial_pressure_index", "campaign_pressure_ratio",
    )
    categorical: tuple[str, ...] = (
        "job", "marital", "education", "contact", "month", "poutcome", "balance_tier", "pdays_group",
    )
    binary: tuple[str, ...] = ("default", "housing", "loan", "is_previously_contacted", "past_success_flag")


@dataclass(frozen=True)
class Split:
    train: float = 0.65
    validation: float = 0.15
    test: float = 0.20
    seed: int = 42


@dataclass(frozen=True)
class Training:
    lr_c: float = 1.0
    lr_max_iter: int = 1000
    gbt_trees: int = 150
    gbt_step: float = 0.05
    gbt_depth: int = 5
    seed: int = 42
    threshold_metric: str = "f1"


@dataclass(frozen=True)
class Settings:
    contracts: Contracts = field(default_factory=Contracts)
    economics: Economics = field(default_factory=Economics)
    tiers: Tiers = field(default_factory=Tiers)
    features: Features = field(default_factory=Features)
    split: Split = field(default_factory=Split)
    training: Training = field(default_factory=Training)


DEFAULT = Settings()


def load_settings(path: str) -> Settings:
    """Settings from a TOML file with one table per group, such as ``[economics]`` with ``call_cost = 4.0``.

    What the file leaves out keeps its default. Unknown groups and names, and values of another kind, are refused.
    """
    with open(path, "rb") as file:
        given = tomllib.load(file)
    groups = {f.name: getattr(DEFAULT, f.name) for f in fields(Settings)}
    changed = {}
    for group, values in given.items():
        if group not in groups or not isinstance(values, dict):
            raise ValueError(f"unknown settings group {group!r}")
        known = {f.name: getattr(groups[group], f.name) for f in fields(groups[group])}
        for name, value in values.items():
            if name not in known:
                raise ValueError(f"unknown setting {group}.{name}")
            wanted = type(known[name])
            if wanted is tuple and isinstance(value, list):
                values[name] = tuple(value)
            elif wanted is float and type(value) is int:
                values[name] = float(value)
            elif type(value) is not wanted:
                raise ValueError(f"{group}.{name} is of kind {wanted.__name__}, not {type(value).__name__}")
        changed[group] = replace(groups[group], **values)
    return replace(DEFAULT, **changed)
