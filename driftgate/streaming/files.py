"""Guard a stream of files of which each may have a schema of its own.

Spark fixes the schema of a stream when it starts: what later files lack reads as null, what they add is not read, and a
column that changes its type ends the stream. Here the stream is one of file names. Each micro-batch reads the schema of every new
file from its footer, deals the files into groups of one schema, and compares each group with the contract by itself, so
drift is found in the file that brings it.

Whatever came, stored rows have one shape: the contract's columns in the contract's types, the reasons, and ``_arrived``, which
holds rows that were held back as they came, as JSON. A retyped column is cast back; values that would not survive that hold
their row back. All groups of a micro-batch are written in one job, into the folder named after the batch, so a replay
overwrites its own first attempt.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from driftgate.functions.columns import apart, col, quoted
from driftgate.functions.probes import altered, any_of, first_reason, missing_text, reason_text, reasons
from driftgate.operators.detect import (
    Finding,
    compare_schema,
    count_columns,
    flag_columns,
    flags,
    outcome_columns,
)
from driftgate.settings import REMOVED_CRITICAL
from driftgate.sources.contracts import Contract
from driftgate.sources.store import ARRIVED, CLEAN, QUARANTINE

#: Files of a micro-batch: so many footers are read, and so many names pass the driver, at a time.
FILES_PER_BATCH = 256
_READERS = 8
_NAMES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


@dataclass(frozen=True)
class _Group:
    """The files of one schema, and how they differ from the contract."""

    number: int
    n_files: int
    rows: DataFrame
    contract: Contract
    findings: Sequence[Finding]

    @property
    def retyped(self) -> dict[str, Finding]:
        return {f.field: f for f in self.findings if f.probe is not None}

    @property
    def required(self) -> list[str]:
        known = self.contract.schema.fields
        must = [f.name for f in known if f.name in self.contract.critical and not f.nullable]
        return [name for name in must if name in self.rows.columns]

    def _tests(self) -> dict[str, Column]:
        spark = self.rows.sparkSession
        tests = {
            reason_text(name): altered(spark, col(name), f.actual, f.expected) for name, f in self.retyped.items()
        }
        return tests | {missing_text(name): col(name).isNull() for name in self.required}

    def labelled(self, seen: Observation) -> DataFrame:
        """Every row in the shape of the store; ``seen`` receives the counts."""
        tests = self._tests()
        came = F.to_json(F.struct(*map(quoted, self.rows.columns))) if self.rows.columns else F.lit("{}")
        flagged = self.rows.select(*map(quoted, self.rows.columns), *flag_columns(tests))
        bad = flags(tests)
        flagged = flagged.observe(seen, *[c.alias(name) for name, c in count_columns(bad).items()])
        why, every, held = F.lit(None).cast("string"), F.lit(None).cast("array<string>"), F.lit(False)
        if bad:
            held = any_of(bad.values())
            why, every = first_reason(bad), F.when(held, reasons(bad))
        if self.whole:
            why = F.lit(f"full_batch:{self.whole}")  # fixed value, as for batches
            every, held = F.array(why), F.lit(True)
        columns = []
        for name, kind in self.contract.types().items():
            value = col(name) if name in self.rows.columns else F.lit(None)
            if name in self.retyped:
                # Where nothing can be cast, every value holds its row back.
                value = value.try_cast(kind) if _casts(self.rows.sparkSession, self.retyped[name].actual, kind) else F.lit(None)
            columns.append(value.cast(kind).alias(name))
        return flagged.select(
            *columns, why.alias("_quarantine_reason"), every.alias("_quarantine_reasons"),
            F.when(held, came).alias(ARRIVED), F.lit(self.number).alias("_group"),
            F.when(held, QUARANTINE).otherwise(CLEAN).alias("_disposition"),
        )

    @property
    def whole(self) -> str | None:
        """Why all rows are held back, if they are."""
        return next((f.anomaly_type for f in self.findings if f.anomaly_type == REMOVED_CRITICAL), None)

    def outcome(self, seen: Observation, batch_id: int, now: str) -> DataFrame:
        """The group's row of the log."""
        counts = {name: F.lit(n).cast("bigint") for name, n in seen.get.items()}
        first = len(self.retyped)
        missing = {name: seen.get[f"bad_{first + i}"] for i, name in enumerate(self.required)}
        pairs = [F.lit(x) for name, n in missing.items() if n for x in (name, n)]
        run_id = F.lit(f"batch_{batch_id}_{self.number}")
        return self.rows.sparkSession.range(1, numPartitions=1).select(
            *outcome_columns(self.findings, self.contract, run_id, F.lit(now), counts),
            F.create_map(*pairs).cast("map<string,bigint>").alias("rows_missing"),
            F.lit(self.number).alias("_group"), F.lit(self.n_files).alias("n_files"),
            F.lit(self.rows.schema.json()).alias("schema_json"),
        )


def _casts(spark: SparkSession, actual: T.DataType, expected: T.DataType) -> bool:
    try:
        spark.range(0).select(F.lit(None).cast(actual).try_cast(expected))  # analysed, not run
    except AnalysisException:
        return False
    return True


def _literal(path: str) -> str:
    """A path that Spark reads as that one file, whatever its name."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _groups(spark: SparkSession, paths: Sequence[str], contract: Contract) -> list[_Group]:
    """The files dealt by schema, in the order of the schemas' texts."""

    def schema_of(path: str) -> str:
        return spark.read.parquet(path).schema.json()

    with ThreadPoolExecutor(_READERS) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(schema_of), paths))
    groups = []
    for number, text in enumerate(sorted(set(found))):
        own = [path for path, schema in zip(paths, found, strict=True) if schema == text]
        schema = T.StructType.fromJson(json.loads(text))
        rows = apart(spark.read.schema(schema).parquet(*own), contract.schema.names)
        findings = [
            f if f.expected is None or f.actual is None else replace(f, probe=f.expected)
            for f in compare_schema(rows.schema, contract)
        ]
        groups.append(_Group(number, len(own), rows, contract, findings))
    return groups


def gate_files(
    spark: SparkSession,
    path: str,
    contract: Contract,
    root: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
    trigger: dict | None = None,
    pattern: str = "*.parquet",
) -> StreamingQuery:
    """Start the gate over the files that land in ``path``; read it with ``read_gate`` and its like."""
    names = (
        spark.readStream.format("binaryFile").schema(_NAMES)
        .option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch)
        .load(path).select("path")  # the contents are not read
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        paths = sorted(_literal(r["path"]) for r in batch.collect())
        if not paths:
            return
        groups = _groups(own, paths, contract)
        seen = [Observation() for _ in groups]
        parts = [group.labelled(count) for group, count in zip(groups, seen, strict=True)]
        rows = reduce(DataFrame.unionAll, parts)
        rows.write.mode("overwrite").partitionBy("_disposition").parquet(f"{root}/batches/_batch_id={batch_id}")
        now = datetime.now().strftime("%Y-%m-%d %H:%M:%S")
        logged = [group.outcome(count, batch_id, now) for group, count in zip(groups, seen, strict=True)]
        reduce(DataFrame.unionAll, logged).coalesce(1).write.mode("overwrite").parquet(f"{root}/log/_batch_id={batch_id}")

    return (
        names.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_arrived(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Rows held back, as they came, read as ``schema`` (DDL), with their reasons."""
    held = spark.read.parquet(f"{root}/batches").filter(F.col("_disposition") == QUARANTINE)
    return held.select(F.from_json(ARRIVED, schema).alias("row"), "_quarantine_reasons").select("row.*", "_quarantine_reasons")
