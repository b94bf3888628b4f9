"""Repair and split a stream against a contract, batch by batch.

The gate keeps no state. Each micro-batch replaces the folder named after its id, so one
that is replayed after a failure overwrites its own first attempt.

A stream has one schema for as long as it runs. Files that come without one of its columns read as
null there, so rows without a value in a critical column that may not be null are held back; columns
that only later files have are not read, and to see them the stream must be started again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftgate.functions.columns import apart, col, count_where
from driftgate.operators.detect import (
    actions_of,
    anomalies_of,
    compare_schema,
    outcome_columns,
)
from driftgate.operators.heal import heal, presume
from driftgate.sources.contracts import Contract


def gate(
    stream: DataFrame,
    contract: Contract,
    root: str,
    checkpoint: str,
    probe: str = "numeric",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the gate. What drifted in type follows from the stream's schema, once, at the start."""
    stream = apart(stream, contract.schema.names)
    findings = compare_schema(stream.schema, contract, probe)
    anomalies = presume(findings)
    critical = [f.name for f in contract.schema.fields if f.name in contract.critical and not f.nullable]
    required = [name for name in critical if name in stream.columns]

    def land(batch: DataFrame, batch_id: int) -> None:
        seen, absent = Observation(), Observation()
        counts = [count_where(col(name).isNull()).alias(f"absent_{i}") for i, name in enumerate(required)]
        watched = batch.observe(absent, *counts) if required else batch
        healed = heal(watched, contract, anomalies, probe=probe, required=required)
        path = f"{root}/batches/_batch_id={batch_id}"
        healed.labelled(seen).write.mode("overwrite").partitionBy("_disposition").parquet(path)
        known = {name: F.lit(n).cast("bigint") for name, n in seen.get.items()}
        missing = {name: absent.get[f"absent_{i}"] for i, name in enumerate(required)}
        pairs = [F.lit(x) for name, n in missing.items() if n for x in (name, n)]
        now = F.lit(datetime.now().strftime("%Y-%m-%d %H:%M:%S"))
        outcome = outcome_columns(findings, contract, F.lit(f"batch_{batch_id}"), now, known)
        logged = batch.sparkSession.range(1, numPartitions=1).select(
            *outcome, F.create_map(*pairs).cast("map<string,bigint>").alias("rows_missing")
        )
        logged.write.mode("overwrite").parquet(f"{root}/log/_batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_gate(spark: SparkSession, root: str, disposition: str) -> DataFrame:
    """Rows that passed (``clean``) or were held back (``quarantine``), with their batch id."""
    rows = spark.read.parquet(f"{root}/batches")
    return rows.filter(F.col("_disposition") == disposition).drop("_disposition")


def read_gate_log(spark: SparkSession, root: str) -> DataFrame:
    """Rows seen and held back by micro-batch, and how many lack a value by critical column."""
    counts = ("_batch_id", "rows_total", "rows_quarantined", "rows_surviving", "rows_missing")
    return spark.read.parquet(f"{root}/log").select(*counts)


def read_gate_anomalies(spark: SparkSession, root: str) -> DataFrame:
    """Anomalies by micro-batch, which is the run."""
    return anomalies_of(spark.read.parquet(f"{root}/log"))


def read_gate_actions(spark: SparkSession, root: str) -> DataFrame:
    """What was done about them, and to how many rows."""
    return actions_of(spark.read.parquet(f"{root}/log"))
