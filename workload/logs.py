"""Queries of run summaries and of the views over the logs.

The logs come from all batches the tables hold: events by day, orders by month and
customers by nation, each drifted in its own way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.operators import assess
from driftgate.operators.detect import anomalies_of
from driftgate.plans import (
    anomaly_events,
    archived_views,
    mirrored_runs,
    quarantine_counts,
    recent_runs,
    recent_summaries,
    run_records,
    summarize_log,
)
from driftgate.sources import RunStore, workspace
from workload.drift import mutate_add_column
from workload.registry import ORACLES, query
from workload.tables import (
    CUSTOMER,
    DAY_END,
    DAY_RUN,
    EVENTS,
    EVENTS_DRIFTED,
    MONTH_END,
    MONTH_RUN,
    NATION_END,
    NATION_RUN,
    ORDERS,
    anomalies_sql,
    day_end,
    day_run,
    events_drifted,
    month_end,
    month_run,
    nation_run,
    table,
)


def assessed_runs(spark, sf_dir) -> DataFrame:
    """Every run over the three tables: one aggregate per table."""
    orders = mutate_add_column(spark, sf_dir)
    customer = table(spark, sf_dir, "customer").drop("c_acctbal")
    return (
        assess(events_drifted(spark, sf_dir), EVENTS, day_run(), day_end())
        .union(assess(orders, ORDERS, month_run(), month_end()))
        .union(assess(customer, CUSTOMER, nation_run(), "2024-01-15 00:00:00"))
    )


def pipeline_log(spark, sf_dir) -> DataFrame:
    return run_records(assessed_runs(spark, sf_dir), "drill", True, "landing/drifted")


_ANOMALIES = " UNION ALL ".join(
    f"SELECT run_id, detected_at, n_rows, n_bad, entity, field, anomaly_type, severity, action, details "
    f"FROM ({sql})"
    for sql in (
        anomalies_sql("events", EVENTS_DRIFTED, DAY_RUN, DAY_END, ("value",)),
        anomalies_sql("orders", "SELECT *, 750 AS credit_score FROM orders", MONTH_RUN, MONTH_END),
        anomalies_sql("customer", "SELECT * EXCLUDE (c_acctbal) FROM customer", NATION_RUN, NATION_END),
    )
)


def _list(column: str) -> str:
    return f"'[''' || array_to_string(list_sort(list(DISTINCT {column})), ''', ''') || ''']'"


_SUMMARY = f"""
SELECT run_id, entity, count(*) AS anomaly_count,
    CASE max(CASE severity WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END)
        WHEN 1 THEN 'LOW' WHEN 2 THEN 'MEDIUM' ELSE 'CRITICAL' END AS max_severity,
    'Schema drift in ' || entity || ' (run ' || run_id || '). ' || count(*) || ' event(s) of types '
        || {_list("anomaly_type")} || ' at severity ' || {_list("severity")}
        || '. Affected fields: ' || {_list("field")}
        || '. Healing actions were applied per the HEALING_ACTION_MATRIX.' AS summary_text,
    max(CASE WHEN action = 'quarantine_batch' THEN n_rows ELSE n_bad END) AS rows_quarantined,
    max(n_rows) - max(CASE WHEN action = 'quarantine_batch' THEN n_rows ELSE n_bad END)
        AS rows_surviving,
    max(detected_at) AS completed_at
FROM ({_ANOMALIES}) GROUP BY run_id, entity
"""
_RECORDS = f"""
SELECT run_id, entity, 'drill' AS drift_type, true AS force_critical, anomaly_count, max_severity,
    rows_quarantined, rows_surviving, summary_text, completed_at, 'landing/drifted' AS drifted_path
FROM ({_SUMMARY})
"""


@query(f"SELECT run_id, entity, anomaly_count, max_severity FROM ({_SUMMARY})")
def run_summary(spark, sf_dir):
    log = anomalies_of(assessed_runs(spark, sf_dir))
    return summarize_log(log).select("run_id", "entity", "anomaly_count", "max_severity")


@query(f"SELECT run_id, summary_text FROM ({_SUMMARY})", name="summary_text")
def summary_texts(spark, sf_dir):
    return summarize_log(anomalies_of(assessed_runs(spark, sf_dir))).select("run_id", "summary_text")


@query(_RECORDS)
def run_log(spark, sf_dir):
    return pipeline_log(spark, sf_dir)


@query(f"""
SELECT to_json({{'run_id': run_id, 'entity': entity, 'drift_type': drift_type,
    'force_critical': force_critical, 'anomaly_count': anomaly_count, 'max_severity': max_severity,
    'rows_quarantined': rows_quarantined, 'rows_surviving': rows_surviving,
    'summary_text': summary_text, 'completed_at': completed_at,
    'drifted_path': drifted_path}})::VARCHAR AS result FROM ({_RECORDS})
""")
def run_result_json(spark, sf_dir):
    log = pipeline_log(spark, sf_dir)
    return log.select(F.to_json(F.struct(*log.columns)).alias("result"))


@query(f"""
SELECT run_id, entity, drift_type, force_critical, anomaly_count, max_severity, rows_surviving,
    rows_quarantined, completed_at
FROM ({_RECORDS}) ORDER BY completed_at DESC, run_id DESC LIMIT 10
""")
def view_recent_runs(spark, sf_dir):
    return recent_runs(pipeline_log(spark, sf_dir))


@query(f"""
SELECT run_id, entity, anomaly_type, severity, field, action, detected_at
FROM ({_ANOMALIES}) ORDER BY detected_at DESC, run_id DESC, field LIMIT 20
""")
def view_anomalies(spark, sf_dir):
    return anomaly_events(anomalies_of(assessed_runs(spark, sf_dir)))


@query(f"""
SELECT run_id, entity, drift_type, max_severity, summary_text, completed_at
FROM ({_RECORDS}) ORDER BY completed_at DESC, run_id DESC LIMIT 5
""")
def view_summaries(spark, sf_dir):
    return recent_summaries(pipeline_log(spark, sf_dir))


@query(f"""
SELECT run_id, rows_quarantined AS n_rows FROM ({_RECORDS})
WHERE rows_quarantined > 0 ORDER BY run_id DESC LIMIT 10
""")
def view_quarantine_counts(spark, sf_dir):
    log = pipeline_log(spark, sf_dir)
    return quarantine_counts(log.select("run_id", F.col("rows_quarantined").alias("n_rows")))


@query(f"""
SELECT run_id, entity, drift_type, max_severity, rows_surviving, rows_quarantined
FROM ({_RECORDS}) ORDER BY completed_at DESC, run_id DESC LIMIT 5
""")
def view_mirror(spark, sf_dir):
    pipeline_log(spark, sf_dir).createOrReplaceTempView("mirrored_log")
    return mirrored_runs(spark, "mirrored_log")


# -- the same views over stored logs ---------------------------------------------------


def _archived(spark, sf_dir, title: str) -> DataFrame:
    """One of the views, over logs that were stored by day first."""
    store = RunStore(spark, workspace(spark, "archive"))
    name = {"anomalies": "anomaly_log", "summaries": "run_summaries"}.get(title, "pipeline_log")
    logged = anomalies_of(assessed_runs(spark, sf_dir)) if name == "anomaly_log" else pipeline_log(spark, sf_dir)
    known = store.empty_log(name).columns
    store.archive_log(name, rows=logged.select(*known))
    return archived_views(store)[title]


for _view, _title in {
    "view_recent_runs": "recent runs", "view_anomalies": "anomalies", "view_summaries": "summaries", "view_mirror": "mirror",
}.items():
    query(ORACLES[_view], name=f"{_view}_archived")(lambda spark, sf_dir, title=_title: _archived(spark, sf_dir, title))
