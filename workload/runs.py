"""Queries that run whole drills, with everything written and read back."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from driftgate.operators import detect, drop_column, heal
from driftgate.plans import run_drill, stored_quarantines
from driftgate.sources import CONTRACTS, RunStore, workspace
from workload.entities import BASELINES
from workload.registry import query
from workload.tables import bad_sql, corrupt_sql

_START = datetime(2024, 1, 31, 12, 0, 0)

# The drills run, by run id: entity, kind, whether forced to be critical.
_DRILLS = {
    "added": ("customers", "column_added", False),
    "removed": ("accounts", "column_removed", False),
    "removed critical": ("transactions", "column_removed", True),
    "retyped": ("transactions", "type_changed", False),
}


def _store(spark, sf_dir, names=tuple(_DRILLS)) -> RunStore:
    """A store prepared with the baselines the drills need, after those drills."""
    store = RunStore(spark, workspace(spark, "drills"))
    entities = {_DRILLS[name][0] for name in names}
    baselines = {entity: BASELINES[entity](spark, sf_dir) for entity in entities}
    store.prepare(baselines, CONTRACTS.values(), "2024-01-31 00:00:00")
    for i, (name, (entity, kind, force)) in enumerate(_DRILLS.items()):
        if name in names:
            as_of = _START + timedelta(minutes=i)
            run_drill(store, store.baseline(entity), store.contract(entity), kind, force, name, as_of)
    return store


# A name that had to be changed ends in its hash.
_CRITICAL = "'run_removed_critical_' || left(md5('removed critical'), 8)"
_BAD = f"(SELECT count(*) FROM events WHERE {bad_sql(corrupt_sql('value', 'event_id::VARCHAR'))})"
_ROWS = {t: f"(SELECT count(*) FROM {t})" for t in ("customer", "orders", "events")}
_DRILL_LOG = f"""
SELECT 'run_added' AS run_id, 'customers' AS entity, 'column_added' AS drift_type,
    false AS force_critical, 1::BIGINT AS anomaly_count, 'LOW' AS max_severity,
    {_ROWS["customer"]} AS rows_surviving, 0::BIGINT AS rows_quarantined,
    '2024-01-31 12:00:00' AS completed_at
UNION ALL SELECT 'run_removed', 'accounts', 'column_removed', false, 1, 'MEDIUM',
    {_ROWS["orders"]}, 0, '2024-01-31 12:01:00'
UNION ALL SELECT {_CRITICAL}, 'transactions', 'column_removed', true, 1, 'CRITICAL',
    0, {_ROWS["events"]}, '2024-01-31 12:02:00'
UNION ALL SELECT 'run_retyped', 'transactions', 'type_changed', false, 1, 'CRITICAL',
    {_ROWS["events"]} - {_BAD}, {_BAD}, '2024-01-31 12:03:00'
"""


@query(_DRILL_LOG)
def drill_runs(spark, sf_dir):
    """Four drills end to end; what the pipeline log says of them."""
    return _store(spark, sf_dir).log("pipeline_log").drop("summary_text", "drifted_path")


@query(f"SELECT run_id, rows_quarantined AS n_rows FROM ({_DRILL_LOG}) WHERE rows_quarantined > 0")
def drill_quarantines(spark, sf_dir):
    """Rows in the quarantine dataset, counted from what was written."""
    return stored_quarantines(_store(spark, sf_dir)).select("run_id", "n_rows")


@query(f"""
SELECT event_id::VARCHAR AS transaction_id, {corrupt_sql("value", "event_id::VARCHAR")} AS amount,
    'unparseable:amount' AS _quarantine_reason, 'run_retyped' AS _run_id
FROM events WHERE {bad_sql(corrupt_sql("value", "event_id::VARCHAR"))}
""")
def drill_quarantined_rows(spark, sf_dir):
    held = _store(spark, sf_dir, ("retyped",)).quarantine("run_retyped")
    return held.select("transaction_id", "amount", "_quarantine_reason", "_run_id")


@query(f"""
SELECT event_id::VARCHAR AS transaction_id, {corrupt_sql("value", "event_id::VARCHAR")} AS amount,
    'run_retyped' AS _run_id
FROM events WHERE NOT {bad_sql(corrupt_sql("value", "event_id::VARCHAR"))}
""")
def drill_clean_rows(spark, sf_dir):
    kept = _store(spark, sf_dir, ("retyped",)).clean("run_retyped")
    return kept.select("transaction_id", "amount", "_run_id")


@query(f"""
SELECT 'run_removed' AS run_id, 'branch_code' AS field, 'fill_null_and_warn' AS applied_action,
    0::BIGINT AS rows_affected
UNION ALL SELECT {_CRITICAL}, 'amount', 'quarantine_batch', {_ROWS["events"]}
UNION ALL SELECT 'run_retyped', 'amount', 'quarantine_affected_records', {_BAD}
UNION ALL SELECT 'run_added', 'preferred_language', 'drop_added_column', 0
""")
def drill_actions(spark, sf_dir):
    log = _store(spark, sf_dir).log("action_log")
    return log.select("run_id", "field", "applied_action", "rows_affected")


def _shared_id(spark, sf_dir) -> RunStore:
    """Three entities whose runs share one id; another id's run broke off before its logs."""
    store = RunStore(spark, workspace(spark, "shared-id"))
    for entity, kind, force in (
        ("transactions", "type_changed", False), ("accounts", "column_removed", True), ("customers", "column_added", False),
    ):
        run_drill(store, BASELINES[entity](spark, sf_dir), CONTRACTS[entity], kind, force, "nightly", _START)
    broken = drop_column(BASELINES["accounts"](spark, sf_dir), "balance")
    found = detect(broken, CONTRACTS["accounts"], "run_broken", "2024-01-31 12:00:00")
    store.write_split(heal(broken, CONTRACTS["accounts"], found), "run_broken")
    run_drill(
        store, BASELINES["customers"](spark, sf_dir), CONTRACTS["customers"], "column_removed", True, "broken", _START
    )
    return store


@query(f"""
SELECT 'run_nightly' AS run_id, 'transactions' AS entity, {_ROWS["events"]} AS n_landed, {_BAD} AS n_held,
    {_ROWS["events"]} - {_BAD} AS n_clean, true AS logged
UNION ALL SELECT 'run_nightly', 'accounts', {_ROWS["orders"]}, {_ROWS["orders"]}, 0, true
UNION ALL SELECT 'run_nightly', 'customers', {_ROWS["customer"]}, 0, {_ROWS["customer"]}, true
UNION ALL SELECT 'run_broken', 'accounts', 0, {_ROWS["orders"]}, 0, false
UNION ALL SELECT 'run_broken', 'customers', {_ROWS["customer"]}, {_ROWS["customer"]}, 0, true
""")
def two_entities_one_id(spark, sf_dir):
    """What each entity's run stored, where several share an id and one broke off."""
    store = _shared_id(spark, sf_dir)
    logged = {(r["run_id"], r["entity"]) for r in store.log("pipeline_log").select("run_id", "entity").collect()}
    rows = []
    for run_id in ("run_nightly", "run_broken"):
        landed = store.entities_of(run_id, "drifted")
        for entity in store.entities_of(run_id):
            n_landed = store.drifted(run_id, entity).count() if entity in landed else 0
            counts = (part(run_id, entity).count() for part in (store.quarantine, store.clean))
            rows.append((run_id, entity, n_landed, *counts, (run_id, entity) in logged))
    return spark.createDataFrame(
        rows, "run_id string, entity string, n_landed long, n_held long, n_clean long, logged boolean"
    )


@query(f"""
SELECT 'run_nightly' AS _run_id, 'transactions' AS _entity, 'clean' AS _disposition
UNION ALL SELECT 'run_nightly', 'transactions', 'quarantine'
UNION ALL SELECT 'run_nightly', 'accounts', 'quarantine'
UNION ALL SELECT 'run_nightly', 'customers', 'clean'
UNION ALL SELECT 'run_broken', 'accounts', 'quarantine'
UNION ALL SELECT 'run_broken', 'customers', 'quarantine'
""")
def stored_partitions(spark, sf_dir):
    """What runs stored, by the catalog's list of partitions."""
    return _shared_id(spark, sf_dir).partitions()


@query(f"""
SELECT event_id::VARCHAR AS transaction_id, {corrupt_sql("value", "event_id::VARCHAR")} AS amount,
    'unparseable:amount' AS _quarantine_reason, 'run_retyped' AS _run_id, 1 AS n_files
FROM events WHERE {bad_sql(corrupt_sql("value", "event_id::VARCHAR"))}
""")
def quarantine_compacted(spark, sf_dir):
    """The quarantined rows of a batch that came in many files, after they were put together."""
    store = RunStore(spark, workspace(spark, "small-files"))
    batch = BASELINES["transactions"](spark, sf_dir).repartition(40, "transaction_id")
    run_drill(store, batch, CONTRACTS["transactions"], "type_changed", False, "retyped", _START)
    store.compact("run_retyped", "transactions")
    held = store.quarantine("run_retyped", "transactions")
    files = len(held.inputFiles())
    return held.select("transaction_id", "amount", "_quarantine_reason", "_run_id", F.lit(files).alias("n_files"))


@query(f"""
SELECT 'run_nightly' AS run_id, 'transactions' AS entity, {_BAD} AS n_rows
UNION ALL SELECT 'run_nightly', 'accounts', {_ROWS["orders"]}
UNION ALL SELECT 'run_broken', 'accounts', {_ROWS["orders"]}
UNION ALL SELECT 'run_broken', 'customers', {_ROWS["customer"]}
""")
def list_quarantines(spark, sf_dir):
    """Quarantines by entity and run from what is stored, whether logged or not."""
    return stored_quarantines(_shared_id(spark, sf_dir)).select("run_id", "entity", "n_rows")
