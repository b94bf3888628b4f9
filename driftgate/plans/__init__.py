"""Whole runs, their logs, and the views over them."""

from driftgate.plans.audit import run_records, summarize_log
from driftgate.plans.run import RunResult, run_batch, run_drill
from driftgate.plans.views import (
    anomaly_events,
    archived_views,
    dashboard,
    mirrored_runs,
    quarantine_counts,
    recent_runs,
    recent_summaries,
    stored_quarantines,
)

__all__ = [
    "RunResult",
    "anomaly_events",
    "archived_views",
    "dashboard",
    "mirrored_runs",
    "quarantine_counts",
    "recent_runs",
    "recent_summaries",
    "run_batch",
    "run_drill",
    "run_records",
    "stored_quarantines",
    "summarize_log",
]
