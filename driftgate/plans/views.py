"""Read-only views over the logs, newest first; ties fall to the run id.

Each is a sort with a limit, which Spark runs as a top-k: no task keeps more rows
than the limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.sources.store import RunStore

# How many rows each view shows.
RUNS, EVENTS, SUMMARIES, QUARANTINES, MIRRORED = 10, 20, 5, 10, 5
# The columns of each view.
RUN_COLUMNS = (
    "run_id", "entity", "drift_type", "force_critical", "anomaly_count", "max_severity",
    "rows_surviving", "rows_quarantined", "completed_at",
)
EVENT_COLUMNS = ("run_id", "entity", "anomaly_type", "severity", "field", "action", "detected_at")
SUMMARY_COLUMNS = ("run_id", "entity", "drift_type", "max_severity", "summary_text", "completed_at")
MIRROR_COLUMNS = (
    "run_id", "entity", "drift_type", "max_severity", "rows_surviving", "rows_quarantined",
)


def _latest(log: DataFrame, columns: Sequence[str], newest: str, n: int) -> DataFrame:
    ties = [F.desc("run_id")] + [F.col(c) for c in ("field",) if c in columns]
    return log.select(*columns).orderBy(F.desc(newest), *ties).limit(n)


def recent_runs(pipeline_log: DataFrame, n: int = RUNS) -> DataFrame:
    """The latest runs."""
    return _latest(pipeline_log, RUN_COLUMNS, "completed_at", n)


def anomaly_events(anomaly_log: DataFrame, n: int = EVENTS) -> DataFrame:
    """The latest anomalies."""
    return _latest(anomaly_log, EVENT_COLUMNS, "detected_at", n)


def recent_summaries(summaries: DataFrame, n: int = SUMMARIES) -> DataFrame:
    """The latest incident summaries."""
    return _latest(summaries, SUMMARY_COLUMNS, "completed_at", n)


def quarantine_counts(per_run: DataFrame, n: int = QUARANTINES) -> DataFrame:
    """The last runs by id that hold quarantined rows, with how many."""
    ties = [F.col(c) for c in ("entity",) if c in per_run.columns]
    return per_run.filter(F.col("n_rows") > 0).orderBy(F.desc("run_id"), *ties).limit(n)


def stored_quarantines(store: RunStore, n: int = QUARANTINES) -> DataFrame:
    """The same, counted from what is stored, also of runs that broke off before they were logged."""
    return quarantine_counts(store.quarantine_counts(store.quarantined_runs(n)), n)


def mirrored_runs(spark: SparkSession, view: str = "pipeline_log", n: int = MIRRORED) -> DataFrame:
    """The latest runs in SQL, over a view such as ``RunStore.register_views`` makes."""
    return spark.sql(
        f"""SELECT {", ".join(MIRROR_COLUMNS)}
            FROM {view} ORDER BY completed_at DESC, run_id DESC LIMIT {int(n)}"""
    )


def archived_views(store: RunStore) -> dict[str, DataFrame]:
    """The views over the archived logs, by title; of each log only the newest days are read that fill the view."""
    newest = store.newest("pipeline_log", max(RUNS, MIRRORED))
    newest.createOrReplaceTempView("archived_pipeline_log")
    return {
        "recent runs": recent_runs(newest),
        "anomalies": anomaly_events(store.newest("anomaly_log", EVENTS)),
        "summaries": recent_summaries(store.newest("run_summaries", SUMMARIES)),
        "mirror": mirrored_runs(store.spark, "archived_pipeline_log"),
    }


def dashboard(store: RunStore) -> dict[str, DataFrame]:
    """Every view the store has data for, by title; the caller shows them."""
    views = {}
    if store.has_log("pipeline_log"):
        views["recent runs"] = recent_runs(store.log("pipeline_log"))
        views["quarantine"] = stored_quarantines(store)
    if store.has_log("anomaly_log"):
        views["anomalies"] = anomaly_events(store.log("anomaly_log"))
    if store.has_log("run_summaries"):
        views["summaries"] = recent_summaries(store.log("run_summaries"))
    return views
