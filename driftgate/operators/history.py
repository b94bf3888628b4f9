"""Judge the runs of a landing table by the contract that was in force when each of them ran.

All versions of an entity's contract are compared with the schema of the table, which costs nothing, and the values of every column that
any version calls to test are counted in one grouped aggregate. Which version's findings count for a run follows from
its time: the newest snapshot not after it, an as-of join with the few versions as a chain of conditions.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftgate.functions.columns import apart, as_column, count_where
from driftgate.functions.probes import any_of
from driftgate.operators.detect import (
    PROBE,
    anomalies_of,
    compare_schema,
    flag_columns,
    flags,
    outcome_columns,
)
from driftgate.sources.contracts import CONTRACTS, Contract, MissingContractError, contract_versions


def assess_as_of(
    df: DataFrame, snapshots: DataFrame, entity: str, run_id, as_of, probe: str = "numeric", missing: str = "fail",
    registry: Mapping[str, Contract] = CONTRACTS,
) -> DataFrame:
    """One row per run, as ``assess`` gives it, judged by the contract of its time, with ``contract_version`` and
    ``contract_since``.

    ``run_id`` and ``as_of`` are texts or columns of ``df``; times are texts as snapshots have them. A run from before the first snapshot fails the job, or with ``missing="skip"`` has a row without
    counts and anomalies.
    """
    if missing not in ("fail", "skip"):
        raise ValueError(f"unknown missing {missing!r}; use 'fail' or 'skip'")
    versions = contract_versions(snapshots, entity, registry)
    if not versions:
        raise MissingContractError(f"no schema snapshot saved for {entity!r}")
    df = apart(df, {name for v in versions for name in v.contract.schema.names})
    findings = [compare_schema(df.schema, v.contract, probe) for v in versions]
    tests, places = {}, []  # one test for each column and type, whatever versions ask for it
    for found in findings:
        own = {f.field: f"{f.probe.simpleString()} {f.field}" for f in found if f.probe is not None}
        tests |= {own[f.field]: f.test() for f in found if f.probe is not None and own[f.field] not in tests}
        places.append(list(own.values()))
    bad = flags(tests)
    counts = [F.count(F.lit(1)).alias("_rows")]
    counts += [count_where(flag).alias(f"_count_{i}") for i, flag in enumerate(bad.values())]
    counts += [count_where(any_of([bad[key] for key in own])).alias(f"_held_{k}") for k, own in enumerate(places) if own]
    keys = [as_column(run_id).alias("_run"), as_column(as_of).alias("_as_of")]
    counted = df.select(*keys, *flag_columns(tests)).groupBy("_run", "_as_of").agg(*counts)

    run, time = F.col("_run"), F.col("_as_of")
    order = list(tests)
    outcomes = []
    for k, (version, found) in enumerate(zip(versions, findings, strict=True)):
        seen = {"rows_total": F.col("_rows"), "rows_bad": F.col(f"_held_{k}") if places[k] else F.lit(0).cast("bigint")}
        seen |= {f"bad_{i}": F.col(f"_count_{order.index(key)}") for i, key in enumerate(places[k])}
        outcomes.append(F.struct(
            *outcome_columns(found, version.contract, run, time, seen),
            F.lit(version.version).alias("contract_version"), F.lit(version.since).alias("contract_since"),
        ))

    def later(chosen: Column, k: int) -> Column:
        return F.when(time >= F.lit(versions[k].since), outcomes[k]).otherwise(chosen)

    text = F.format_string(f"no schema snapshot of {entity.replace('%', '%%')} in force at %s, run %s", time, run)
    kind = counted.select(outcomes[0].alias("o")).schema["o"].dataType
    none = F.raise_error(text) if missing == "fail" else F.lit(None)
    chosen = reduce(later, range(len(versions)), none.cast(kind))
    facts = [F.col("o")[f.name].alias(f.name) for f in kind.fields[3:]]
    own = [run.alias("run_id"), F.lit(entity).alias("entity"), time.alias("detected_at")]
    return counted.select(*own, chosen.alias("o")).select("run_id", "entity", "detected_at", *facts)


def detect_as_of(
    df: DataFrame, snapshots: DataFrame, entity: str, run_id, as_of, probe: str = "numeric", missing: str = "fail",
    registry: Mapping[str, Contract] = CONTRACTS,
) -> DataFrame:
    """The anomalies of every run, by the contract in force at its time; see :func:`assess_as_of`."""
    found = anomalies_of(assess_as_of(df, snapshots, entity, run_id, as_of, probe, missing, registry))
    return found.withMetadata("field", {PROBE: probe})
