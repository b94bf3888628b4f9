"""Fixed values of the drift rules: severities, actions, drift drills, limits.

Everything here is a constant that results depend on; the logic that uses it
lives in the operator modules.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# Anomaly types.
ADDED = "schema_drift_column_added"
REMOVED = "schema_drift_column_removed_non_critical"
REMOVED_CRITICAL = "schema_drift_column_removed_critical"
RETYPED_SAFE = "schema_drift_type_change_safe"
RETYPED_UNSAFE = "schema_drift_type_change_unsafe"

# Actions.
DROP_ADDED = "drop_added_column"
FILL_NULL = "fill_null_and_warn"
CAST_AND_WARN = "cast_and_warn"
QUARANTINE_BATCH = "quarantine_batch"
QUARANTINE_ROWS = "quarantine_affected_records"

# Severities from mildest to worst.
SEVERITIES = ("NONE", "LOW", "MEDIUM", "CRITICAL")


@dataclass(frozen=True)
class Rule:
    """What an anomaly type means: how bad it is and what is done about it."""

    anomaly_type: str
    severity: str
    action: str


# The action matrix.
RULES = {
    r.anomaly_type: r
    for r in (
        Rule(ADDED, "LOW", DROP_ADDED),
        Rule(REMOVED, "MEDIUM", FILL_NULL),
        Rule(REMOVED_CRITICAL, "CRITICAL", QUARANTINE_BATCH),
        Rule(RETYPED_SAFE, "MEDIUM", CAST_AND_WARN),
        Rule(RETYPED_UNSAFE, "CRITICAL", QUARANTINE_ROWS),
    )
}

# The order in which kinds of drift are reported.
KIND_ORDER = {ADDED: 0, REMOVED: 1, REMOVED_CRITICAL: 1, RETYPED_SAFE: 2, RETYPED_UNSAFE: 2}


@dataclass(frozen=True)
class Drill:
    """The drift a drill applies to one entity, one change per kind."""

    add: tuple[str, str, object]
    remove: str
    remove_critical: str
    retype: str
    retype_unsafe: bool


# Kinds of drill.
DRILL_KINDS = ("column_added", "column_removed", "type_changed")

# The drill of each entity.
DRILLS = {
    "transactions": Drill(("loyalty_tier", "string", "GOLD"), "merchant_name", "amount", "amount", True),
    "accounts": Drill(("credit_score", "int", 750), "branch_code", "balance", "balance", True),
    "customers": Drill(("preferred_language", "string", "en"), "phone", "email", "date_of_birth", False),
}

# Share of values an unsafe retype overwrites, in ten-thousandths,
# first with N/A and then, of the rest, with ERROR.
NOT_AVAILABLE_SHARE = 3000
ERROR_SHARE = 2000

# Allowed values of the coded columns, with expected weights where known.
DOMAINS = {
    "transaction_type": {"DEBIT": 35, "CREDIT": 30, "TRANSFER": 20, "PAYMENT": 15},
    "currency": {"USD": 50, "EUR": 20, "GBP": 15, "INR": 15},
    "channel": {"ONLINE": 35, "ATM": 15, "POS": 25, "MOBILE": 20, "BRANCH": 5},
    "transaction_status": {"COMPLETED": 85, "PENDING": 8, "FAILED": 5, "REVERSED": 2},
    "account_type": {"SAVINGS": 1, "CHECKING": 1, "CREDIT": 1, "LOAN": 1},
    "account_status": {"ACTIVE": 75, "DORMANT": 10, "CLOSED": 10, "FROZEN": 5},
    "kyc_status": {"VERIFIED": 70, "PENDING": 15, "REJECTED": 5, "EXPIRED": 10},
    "risk_rating": {"LOW": 60, "MEDIUM": 30, "HIGH": 10},
}

# Allowed balance by account type.
BALANCE_BOUNDS = {
    "SAVINGS": (100.0, 500000.0),
    "CHECKING": (50.0, 100000.0),
    "CREDIT": (-50000.0, 0.0),
    "LOAN": (-1000000.0, -1000.0),
}

# Upper edge of each amount band and its expected share in percent.
AMOUNT_BANDS = ((100.0, 60), (1000.0, 25), (10000.0, 12), (100000.0, 3))

# Expected activity weight of each hour, 0 to 23.
HOUR_WEIGHTS = (1, 1, 1, 1, 1, 2, 4, 6, 8, 9, 10, 10, 9, 8, 7, 6, 5, 7, 8, 9, 7, 5, 3, 2)


@dataclass(frozen=True)
class Limits:
    """Limits of the quality checks. A value that exceeds its limit is flagged."""

    # The default limits.
    critical_null_rate: float = 0.05
    null_rate: float = 0.10
    empty_rate: float = 0.03
    all_null_rate: float = 0.002
    null_spike_rate: float = 0.25
    volume_spike: float = 2.0
    volume_drop: float = 0.5
    trailing_days: int = 7
    decline_rate: float = 0.10
    decline_days: int = 5

    def with_(self, **changes) -> "Limits":
        return replace(self, **changes)


# Named limit profiles, differing in the null rate they accept.
PROFILES = {
    "clean": Limits(critical_null_rate=0.0, null_rate=0.0, empty_rate=0.0, all_null_rate=0.0),
    "light": Limits(critical_null_rate=0.02),
    "moderate": Limits(critical_null_rate=0.05),
    "heavy": Limits(critical_null_rate=0.15),
}


def profile(name: str) -> Limits:
    """The limits registered under a profile name."""
    if name not in PROFILES:
        raise ValueError(f"unknown profile {name!r}; known: {sorted(PROFILES)}")
    return PROFILES[name]
