"""Repair a drifted batch, or hold back what cannot be repaired.

A batch becomes one DataFrame in which every row carries its disposition, clean
or quarantine, and why. It can therefore be written in a single pass, however
many columns hold bad values.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftgate.functions.columns import apart, col, quoted
from driftgate.functions.nested import reshaped
from driftgate.functions.probes import (
    any_of,
    first_reason,
    missing_text,
    reason_text,
    reasons,
)
from driftgate.operators.detect import (
    PROBE,
    Finding,
    compare_schema,
    count_columns,
    flag_columns,
    flags,
    in_report_order,
)
from driftgate.settings import (
    CAST_AND_WARN,
    DROP_ADDED,
    FILL_NULL,
    QUARANTINE_BATCH,
    QUARANTINE_ROWS,
    RULES,
)
from driftgate.sources.contracts import Contract
from driftgate.sources.store import ARRIVED, CLEAN, QUARANTINE

_LABELS = ("_quarantine_reason", "_quarantine_reasons", "_disposition")


@dataclass(frozen=True)
class Healed:
    """A batch with its repairs applied; nothing has been computed yet."""

    source: DataFrame
    contract: Contract
    dropped: frozenset[str]
    filled: frozenset[str]
    tests: Mapping[str, Column]
    batch_reason: str | None
    casts: frozenset[str] = field(default_factory=frozenset)
    required: tuple[str, ...] = ()
    reshaped: frozenset[str] = field(default_factory=frozenset)

    def _repaired(self) -> list:
        """Contract columns in contract order, then the others as they came.

        Labels of an earlier run, on rows that come back from quarantine, give way to new ones.
        """
        kept = [name for name in self.source.columns if name not in (*_LABELS, ARRIVED)]
        if self.batch_reason:
            return [quoted(name) for name in kept]
        present = [name for name in kept if name not in self.dropped]
        columns = []
        for name, data_type in self.contract.types().items():
            if name in self.reshaped:
                rebuilt = reshaped(col(name), self.source.schema[name].dataType, data_type)
                columns.append(rebuilt.alias(name))
            elif name in present:
                columns.append(quoted(name))
            elif name in self.filled:
                columns.append(F.lit(None).cast(data_type).alias(name))
        expected = self.contract.types()
        return columns + [quoted(name) for name in present if name not in expected]

    def labelled(self, seen: Observation | None = None) -> DataFrame:
        """Every row of the batch with its reasons and disposition.

        ``seen`` receives the counts named by ``count_columns`` when the result is written.
        """
        tests = {reason_text(name): test for name, test in self.tests.items()}
        tests |= {missing_text(name): col(name).isNull() for name in self.required}
        repaired = self._repaired()
        tested = self.source.select(*repaired, *flag_columns(tests))
        names = tested.columns[: len(repaired)]
        bad = flags(tests)
        if seen is not None:
            counts = count_columns(bad)
            tested = tested.observe(seen, *[c.alias(name) for name, c in counts.items()])
        none = F.lit(None).cast("string")
        if self.batch_reason:
            why = F.lit(self.batch_reason)
            labels = [why, F.array(why), F.lit(QUARANTINE)]
        elif bad:
            held = any_of(bad.values())
            every = F.when(held, reasons(bad))
            labels = [first_reason(bad), every, F.when(held, QUARANTINE).otherwise(CLEAN)]
        else:
            labels = [none, F.lit(None).cast("array<string>"), F.lit(CLEAN)]
        return tested.select(
            *map(quoted, names), *[c.alias(name) for c, name in zip(labels, _LABELS, strict=True)]
        )

    def stored(self, seen: Observation | None = None) -> DataFrame:
        """The labelled batch as one write can take it: every row of one shape.

        Columns that are cast are cast in all rows; what they held in rows held back stays in ``_arrived``.
        """
        rows = self.labelled(seen)
        if not self.casts:
            return rows
        arrived = F.struct(*[quoted(name) for name in rows.columns if name in self.casts])
        held = F.when(F.col("_disposition") == QUARANTINE, arrived)
        return rows.withColumns({ARRIVED: held} | self._cast(rows.schema))

    def _cast(self, schema: T.StructType) -> dict:
        types = self.contract.types()
        return {name: reshaped(col(name), schema[name].dataType, types[name], True) for name in self.casts}

    @property
    def clean(self) -> DataFrame | None:
        """Rows that passed; None if the whole batch is held back."""
        if self.batch_reason:
            return None
        kept = self.labelled().filter(F.col("_disposition") == CLEAN).drop(*_LABELS)
        return kept.withColumns(self._cast(kept.schema))

    @property
    def quarantine(self) -> DataFrame:
        """Rows held back: the batch as it arrived, or its bad rows with every reason."""
        return self.labelled().filter(F.col("_disposition") == QUARANTINE).drop("_disposition")

    @property
    def quarantine_by_reason(self) -> DataFrame:
        """Rows held back, once per reason, which is in ``reason``."""
        # Every such row has a reason; the outer form keeps Spark from testing for it by
        # working out the reasons a second time below.
        held = self.quarantine
        kept = [quoted(name) for name in held.columns if name not in _LABELS]
        return held.select(*kept, F.explode_outer("_quarantine_reasons").alias("reason"))


def _as_mapping(anomaly) -> Mapping:
    return anomaly.asDict() if isinstance(anomaly, Row) else anomaly


def probe_for(probe: str, on_safe: str) -> str:
    """The probe to use: casting needs to know of every value that would not survive it."""
    return "all" if on_safe == "cast" else probe


def presume(findings: Iterable[Finding]) -> list[dict]:
    """Anomalies to plan for before any value is tested.

    A column that may hold bad values is split as if it did; if it does not, the split
    leaves every row clean.
    """
    return [
        {
            "anomaly_type": f.anomaly_type,
            "field": f.field,
            "action": QUARANTINE_ROWS if f.probe is not None else RULES[f.anomaly_type].action,
        }
        for f in findings
    ]


def heal(
    df: DataFrame,
    contract: Contract,
    anomalies: DataFrame | Iterable,
    on_safe: str = "keep",
    probe: str | None = None,
    required: Iterable[str] = (),
) -> Healed:
    """Plan the repairs that the anomalies of one run call for.

    ``on_safe`` says what becomes of a retyped column in clean rows: ``keep`` leaves the
    new type and only warns, ``cast`` turns text back into the contract's type. So that no
    value is lost, ``cast`` tests every such column for exactly that type, and rows that
    fail go to quarantine.
    Rows are held back for the values that were found: with the ``probe`` given, or else the one that the anomalies of
    ``detect`` carry, or else the numeric one.
    Rows without a value in a ``required`` column go to quarantine too.
    A DataFrame of anomalies is collected; one run has at most one per column, and more are refused.
    Columns whose names differ only in case are told apart first; see :func:`apart`.
    Inside structs, arrays and maps, fields are dropped and filled in place: a column with such an anomaly is rebuilt
    in the contract's shape.
    """
    if on_safe not in ("keep", "cast"):
        raise ValueError(f"unknown on_safe {on_safe!r}; use 'keep' or 'cast'")
    df = apart(df, contract.schema.names)
    if isinstance(anomalies, DataFrame):
        probe = probe or anomalies.schema["field"].metadata.get(PROBE)
    probe = probe_for(probe or "numeric", on_safe)
    known = {f.field: f for f in compare_schema(df.schema, contract, probe)}
    if isinstance(anomalies, DataFrame):
        most = len(set(df.columns) | set(contract.types())) + len(known)
        anomalies = in_report_order(anomalies).limit(most + 1).collect()
        if len(anomalies) > most or len({a["run_id"] for a in anomalies}) > 1:
            raise ValueError("these are the anomalies of several runs; heal takes those of one")
    dropped, filled, casts, rebuilt, tests, batch_reason = set(), set(), set(), set(), {}, None
    for anomaly in map(_as_mapping, anomalies):
        action, name = anomaly["action"], anomaly["field"]
        finding = known.get(name)
        nested = finding is not None and finding.nested
        if action in (DROP_ADDED, FILL_NULL):
            (rebuilt if nested else dropped if action == DROP_ADDED else filled).add(finding.column if nested else name)
        elif action in (CAST_AND_WARN, QUARANTINE_ROWS):
            tested = finding if finding is not None and finding.probe is not None else None
            if on_safe == "cast" and tested:
                casts.add(tested.column)
            if action == QUARANTINE_ROWS and not tested:  # found by a wider probe than this one
                wider = {f.field: f for f in compare_schema(df.schema, contract, "all")}.get(name)
                tested = wider if wider is not None and wider.probe is not None else None
            if action == QUARANTINE_ROWS and not tested:
                raise ValueError(f"no test of {name!r} is known that could tell its bad rows")
            if tested and (action == QUARANTINE_ROWS or tested.column in casts):
                tests[name] = tested.test()
        elif action == QUARANTINE_BATCH:
            # The batch is kept as it came; later columns are still tested, only to be counted.
            # Fixed value: why a whole batch is held back.
            batch_reason = batch_reason or f"full_batch:{anomaly['anomaly_type']}"
        else:
            raise ValueError(f"unknown action {action!r}")
    if batch_reason:
        casts.clear()
    return Healed(
        df, contract, frozenset(dropped), frozenset(filled), tests, batch_reason, frozenset(casts),
        tuple(name for name in required if name in df.columns), frozenset(rebuilt),
    )
