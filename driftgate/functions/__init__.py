"""Column expressions shared by the operators; all of them run in the JVM."""

from driftgate.functions.columns import (
    anomaly_id,
    col,
    default_run_id,
    hash_bucket,
    resolve_run_id,
    sanitize_run_id,
)
from driftgate.functions.probes import first_reason, parseable, reasons, unparseable
from driftgate.functions.text import quoted_list, severity_rank, summary_text, type_name

__all__ = [
    "anomaly_id",
    "col",
    "default_run_id",
    "first_reason",
    "hash_bucket",
    "parseable",
    "quoted_list",
    "reasons",
    "resolve_run_id",
    "sanitize_run_id",
    "severity_rank",
    "summary_text",
    "type_name",
    "unparseable",
]
