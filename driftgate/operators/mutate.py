"""Drift drills: apply a known drift to good data to see how a pipeline copes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.functions.columns import col, hash_bucket, quoted
from driftgate.settings import DRILL_KINDS, ERROR_SHARE, NOT_AVAILABLE_SHARE, Drill
from driftgate.sources.contracts import Contract
from driftgate.sources.store import RunStore


@dataclass(frozen=True)
class Drilled:
    """A drifted batch and what was done to it."""

    df: DataFrame
    column: str
    critical: bool


def add_column(df: DataFrame, name: str, data_type: str, value) -> DataFrame:
    """Add a constant column nobody expects."""
    return df.withColumn(name, F.lit(value).cast(data_type))


def _require(df: DataFrame, name: str) -> None:
    if name not in df.columns:
        raise ValueError(f"the batch has no column {name!r}; it has {df.columns}")


def drop_column(df: DataFrame, name: str) -> DataFrame:
    """Remove a column."""
    _require(df, name)
    return df.select(*[quoted(c) for c in df.columns if c != name])


def retype_to_string(
    df: DataFrame, name: str, key: Sequence[str] = (), corrupt: bool = False, salt: int = 42
) -> DataFrame:
    """Turn a column into text; with ``corrupt``, overwrite a share of it with junk.

    Which rows are overwritten depends on the hash of ``key`` alone, so a re-run, a
    retried task or another partitioning gives the same batch.
    """
    _require(df, name)
    text = col(name).cast("string")
    if corrupt:
        if not key:
            raise ValueError("corrupting a column needs the key of its rows")
        text = (
            F.when(hash_bucket(key, salt) < NOT_AVAILABLE_SHARE, F.lit("N/A"))
            .when(hash_bucket(key, salt + 1) < ERROR_SHARE, F.lit("ERROR"))
            .otherwise(text)
        )
    return df.withColumn(name, text)


def drill(
    df: DataFrame, spec: Drill, kind: str, key: Sequence[str], force_critical: bool = False
) -> Drilled:
    """Apply the drift of one kind that ``spec`` describes."""
    if kind == "column_added":
        name = spec.add[0]
        return Drilled(add_column(df, *spec.add), name, False)
    if kind == "column_removed":
        name = spec.remove_critical if force_critical else spec.remove
        return Drilled(drop_column(df, name), name, force_critical)
    if kind == "type_changed":
        unsafe = spec.retype_unsafe or force_critical
        return Drilled(retype_to_string(df, spec.retype, key, unsafe), spec.retype, unsafe)
    raise ValueError(f"unknown drift {kind!r}; known: {DRILL_KINDS}")


def inject(
    store: RunStore, df: DataFrame, spec: Drill, kind: str, contract: Contract, run_id: str,
    force_critical: bool = False,
) -> tuple[DataFrame, str, Drilled]:
    """Apply a drill and land the drifted batch; returns the landed batch, its path and the drill.

    The batch is read back from where it landed, so what follows does not redo the drill.
    """
    done = drill(df, spec, kind, contract.key, force_critical)
    path = store.write_drifted(done.df, contract.entity, run_id)
    return store.spark.read.schema(done.df.schema).parquet(path), path, done
