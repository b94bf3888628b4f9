"""Drift detection, repair, drills and quality checks."""

from driftgate.operators.catalog import diff_schema_rows, rule_frame, schema_rows
from driftgate.operators.detect import Finding, assess, compare_schema, detect
from driftgate.operators.heal import Healed, heal
from driftgate.operators.history import assess_as_of, detect_as_of
from driftgate.operators.integrity import key_duplicates, orphan_keys, orphan_summary
from driftgate.operators.mutate import (
    add_column,
    drill,
    drop_column,
    inject,
    retype_to_string,
)
from driftgate.operators.ledger import KeyLedger
from driftgate.operators.quality import (
    amount_bands,
    domain_share,
    domain_violations,
    hour_profile,
    null_profile,
    null_spikes,
    range_violations,
)
from driftgate.operators.ranges import daily_profiles, profile_range, read_profiles, store_profiles
from driftgate.operators.volume import judge_days, volume_by_day

__all__ = [
    "Finding",
    "Healed",
    "KeyLedger",
    "add_column",
    "amount_bands",
    "assess",
    "assess_as_of",
    "compare_schema",
    "daily_profiles",
    "detect",
    "detect_as_of",
    "diff_schema_rows",
    "domain_share",
    "domain_violations",
    "drill",
    "drop_column",
    "heal",
    "hour_profile",
    "judge_days",
    "inject",
    "key_duplicates",
    "null_profile",
    "null_spikes",
    "orphan_keys",
    "orphan_summary",
    "profile_range",
    "range_violations",
    "read_profiles",
    "retype_to_string",
    "rule_frame",
    "schema_rows",
    "store_profiles",
    "volume_by_day",
]
