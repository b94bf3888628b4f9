"""One run over one batch: detect, repair, write, log."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.functions.columns import apart, resolve_run_id
from driftgate.operators.detect import (
    actions_of,
    anomalies_of,
    compare_schema,
    outcome_columns,
)
from driftgate.operators.heal import heal, presume, probe_for
from driftgate.operators.mutate import inject
from driftgate.plans.audit import SUMMARY_FIELDS, run_records
from driftgate.settings import DRILL_KINDS, DRILLS, Drill
from driftgate.sources.contracts import Contract
from driftgate.sources.store import RunStore


@dataclass(frozen=True)
class RunResult:
    """What a run did."""

    run_id: str
    record: dict

    def json(self) -> str:
        """The run's record for an orchestrator."""
        return json.dumps(self.record, default=str)


def _clock(as_of: datetime | None) -> datetime:
    return as_of or datetime.now()


def run_batch(
    store: RunStore,
    df: DataFrame,
    contract: Contract,
    run_id: str | None = None,
    as_of: datetime | None = None,
    *,
    drift_type: str | None = None,
    force_critical: bool | None = None,
    drifted_path: str | None = None,
    probe: str = "numeric",
    on_safe: str = "keep",
) -> RunResult:
    """Guard one batch end to end, reading it once.

    Which rows are split off does not depend on how many there are, so the batch is written
    straight away and the bad values are counted in the same pass. The counts then decide
    the severities that go to the logs.
    """
    now = _clock(as_of)
    run_id = resolve_run_id(run_id, now)
    return _run(
        store, df, contract, run_id, now, drift_type, force_critical, drifted_path, probe, on_safe
    )


def _run(store, df, contract, run_id, now, drift_type, force_critical, drifted_path, probe, on_safe):
    df = apart(df, contract.schema.names)
    findings = compare_schema(df.schema, contract, probe_for(probe, on_safe))
    healed = heal(df, contract, presume(findings), on_safe, probe)
    counts = store.write_split(healed, run_id)
    seen = {name: F.lit(n).cast("bigint") for name, n in counts.items()}
    as_of = F.lit(now.strftime("%Y-%m-%d %H:%M:%S"))
    assessed = store.spark.range(1, numPartitions=1).select(
        *outcome_columns(findings, contract, F.lit(run_id), as_of, seen)
    )
    records = run_records(assessed, drift_type, force_critical, drifted_path)
    logs = {"run_summaries": records.select(*SUMMARY_FIELDS), "pipeline_log": records}
    if findings:
        held = F.when(F.col("rows_affected") > 0, F.lit(store.quarantine_path(contract.entity, run_id)))
        logs["anomaly_log"] = anomalies_of(assessed)
        logs["action_log"] = actions_of(assessed).withColumn("result_path", held)
    else:  # a run that is repeated on better data leaves nothing of the first one behind
        logs |= {name: store.empty_log(name) for name in ("anomaly_log", "action_log")}
    commit = logs.pop("pipeline_log")
    # A handful of rows each: the time goes into starting the jobs, so start them together,
    # in the caller's job group and pool.
    append = inheritable_thread_target(store.spark)(store.append_log)
    with ThreadPoolExecutor(len(logs)) as pool:
        written = [pool.submit(append, name, df, run_id, contract.entity) for name, df in logs.items()]
        record = records.first().asDict()
        for log in written:
            log.result()
    store.append_log("pipeline_log", commit, run_id, contract.entity)  # last: a run counts once all else stands
    return RunResult(run_id, record)


def run_drill(
    store: RunStore,
    df: DataFrame,
    contract: Contract,
    drift_type: str,
    force_critical: bool = False,
    run_id: str | None = None,
    as_of: datetime | None = None,
    spec: Drill | None = None,
) -> RunResult:
    """Apply a drill to good data, land the drifted batch and run over it."""
    if drift_type not in DRILL_KINDS:
        raise ValueError(f"unknown drift {drift_type!r}; known: {DRILL_KINDS}")
    spec = spec or DRILLS.get(contract.entity)
    if spec is None:
        raise ValueError(f"no drill for {contract.entity!r}; known: {sorted(DRILLS)}")
    now = _clock(as_of)
    run_id = resolve_run_id(run_id, now)
    landed, path, _ = inject(store, df, spec, drift_type, contract, run_id, force_critical)
    return _run(
        store, landed, contract, run_id, now, drift_type, force_critical, path, "numeric", "keep"
    )
