"""Compare a batch with its contract and classify what differs.

Which columns were added, removed or retyped follows from the two schemas alone.
Only one question needs the data: how many values of a retyped column no longer
parse. All such columns are counted in a single aggregate that reads no others,
and which can cover many runs at once when the run id is a column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftgate.functions.columns import anomaly_id, apart, as_column, col, count_where, zipped
from driftgate.functions.nested import Step, anywhere, differences, path_text
from driftgate.functions.probes import any_of, unparseable
from driftgate.functions.text import type_name
from driftgate.settings import (
    ADDED,
    KIND_ORDER,
    REMOVED,
    REMOVED_CRITICAL,
    RETYPED_SAFE,
    RETYPED_UNSAFE,
    RULES,
)
from driftgate.sources.contracts import Contract

# Columns of an anomaly, all strings.
ANOMALY_FIELDS = (
    "anomaly_id", "run_id", "anomaly_type", "severity", "entity", "field", "detected_at",
    "details", "action",
)
# What the action list adds.
ACTION_FIELDS = (*ANOMALY_FIELDS, "applied_action", "rows_affected")
_ENTRIES = (
    "array<struct<"
    + "".join(f"{name}: STRING, " for name in ANOMALY_FIELDS)
    + "applied_action: STRING, rows_affected: BIGINT, acted: BOOLEAN>>"
)


# Ours: where the anomalies of ``detect`` say what they were tested with.
PROBE = "probe"


@dataclass(frozen=True)
class Finding:
    """One difference between a batch and its contract.

    ``probe`` is the type the column's text must still parse as; with it, the
    finding is unsafe as soon as one value does not.
    """

    anomaly_type: str
    field: str
    expected: T.DataType | None = None
    actual: T.DataType | None = None
    probe: T.DataType | None = None
    column: str | None = None
    steps: tuple[Step, ...] = ()

    @property
    def nested(self) -> bool:
        """Whether the difference lies inside a column, which then has ``steps`` to it."""
        return bool(self.steps)

    def test(self) -> Column:
        """True for rows with a value there that does not parse."""
        return anywhere(col(self.column or self.field), self.steps, lambda v: unparseable(v, self.probe))

    @property
    def details(self) -> str:
        # The three templates.
        if self.anomaly_type == ADDED:
            return f"Unexpected new column '{self.field}' ({type_name(self.actual)})."
        if self.expected is not None and self.actual is not None:
            return (
                f"Type drift on '{self.field}': expected {type_name(self.expected)}, "
                f"got {type_name(self.actual)}"
            )
        return f"Expected column '{self.field}' missing from source."


def probe_type(actual: T.DataType, expected: T.DataType, probe: str) -> T.DataType | None:
    """The type to test text against, or None if the retype is safe by definition.

    ``numeric`` tests text where a double or an integer is expected, both as double;
    ``all`` tests text against any expected simple type, exactly.
    """
    if not isinstance(actual, T.StringType):
        return None
    if probe == "numeric":
        return T.DoubleType() if isinstance(expected, (T.DoubleType, T.IntegerType)) else None
    if probe == "all":
        nested = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.NullType, T.StringType)
        return None if isinstance(expected, nested) else expected
    raise ValueError(f"unknown probe {probe!r}; use 'numeric' or 'all'")


def compare_schema(
    schema: T.StructType, contract: Contract, probe: str = "numeric"
) -> list[Finding]:
    """Differences in the order added, removed, retyped, each by field name.

    Names match by exact case; order and nullability do not matter; columns that
    start with ``_`` are metadata on both sides. Structs, arrays and maps are compared inside:
    a field added to a struct is an added field, ``payload.tier``, not a retyped column.
    """
    expected = contract.types()
    actual = {f.name: f.dataType for f in schema.fields if not f.name.startswith("_")}
    findings = [Finding(ADDED, name, actual=actual[name]) for name in actual if name not in expected]
    for name, wanted in expected.items():
        if name not in actual:
            kind = REMOVED_CRITICAL if name in contract.critical else REMOVED
            findings.append(Finding(kind, name, expected=wanted))
        else:
            findings += [
                _finding(name, steps, got, agreed, contract, probe)
                for steps, got, agreed in differences(actual[name], wanted)
            ]
    return sorted(findings, key=lambda f: (KIND_ORDER[f.anomaly_type], f.field))


def _finding(column, steps, got, agreed, contract: Contract, probe: str) -> Finding:
    """A difference inside a column, or of the whole."""
    field = path_text(column, steps)
    if agreed is None:
        return Finding(ADDED, field, actual=got, column=column, steps=steps)
    if got is None:
        kind = REMOVED_CRITICAL if field in contract.critical else REMOVED
        return Finding(kind, field, expected=agreed, column=column, steps=steps)
    return Finding(RETYPED_SAFE, field, agreed, got, probe_type(got, agreed, probe), column, steps)


def bad_value_tests(findings: Sequence[Finding]) -> dict[str, Column]:
    """The unparseable-value test of each finding that needs one, by field."""
    return {f.field: f.test() for f in findings if f.probe is not None}


def flag_columns(tests: Mapping[str, Column]) -> list[Column]:
    """The tests as columns. Selecting them before use has each value parsed only once."""
    return [test.alias(f"_bad_{i}") for i, test in enumerate(tests.values())]


def flags(tests: Mapping[str, Column]) -> dict[str, Column]:
    """References to :func:`flag_columns`, by field."""
    return {name: F.col(f"_bad_{i}") for i, name in enumerate(tests)}


def count_columns(bad: Mapping[str, Column]) -> dict[str, Column]:
    """Aggregates over a flagged batch: rows, rows with any bad value, bad values by column."""
    counts = {"rows_total": F.count(F.lit(1)), "rows_bad": count_where(any_of(bad.values()))}
    for i, flag in enumerate(bad.values()):
        counts[f"bad_{i}"] = count_where(flag)
    return counts


def outcome_columns(
    findings: Sequence[Finding], contract: Contract, run_id: Column, as_of: Column,
    counts: Mapping[str, Column],
) -> list[Column]:
    """Row counts of a run, its anomalies, and the action taken on each.

    ``counts`` may hold aggregate columns or literals, by the names of :func:`count_columns`.
    """
    total = counts["rows_total"]
    held = total if any(f.anomaly_type == REMOVED_CRITICAL for f in findings) else counts["rows_bad"]
    return [
        run_id.alias("run_id"),
        F.lit(contract.entity).alias("entity"),
        as_of.alias("detected_at"),
        total.alias("rows_total"),
        held.alias("rows_quarantined"),
        (total - held).alias("rows_surviving"),
        _entries(findings, contract, run_id, as_of, counts).alias("anomalies"),
    ]


def _entries(findings, contract, run_id, as_of, counts) -> Column:
    """The findings as an array of anomalies, each with what was done about it.

    What the schemas tell goes in as constants; a finding with a probe turns unsafe if
    its count of bad values is not zero.
    """
    if not findings:
        return F.array().cast(_ENTRIES)
    bad, acted, moved, stopped = [], [], [], False
    none = F.lit(None).cast("bigint")
    tested = [f.field for f in findings if f.probe is not None]
    for finding in findings:
        known_bad = finding.field in tested
        bad.append(counts[f"bad_{tested.index(finding.field)}"] if known_bad else none)
        whole = finding.anomaly_type == REMOVED_CRITICAL and not stopped
        moved.append(counts["rows_total"] if whole else bad[-1])
        acted.append(not stopped)
        # Once the batch as a whole is held back, nothing more is done to it.
        stopped = stopped or whole
    known = [RULES[f.anomaly_type] for f in findings]
    facts = zipped(
        kind=[r.anomaly_type for r in known], severity=[r.severity for r in known],
        action=[r.action for r in known], field=[f.field for f in findings],
        details=[f.details for f in findings], bad=bad, moved=moved, acted=acted,
    )
    unsafe, entity = RULES[RETYPED_UNSAFE], F.lit(contract.entity)

    def entry(fact: Column) -> Column:
        turned = F.coalesce(fact["bad"] > 0, F.lit(False))
        kind = F.when(turned, unsafe.anomaly_type).otherwise(fact["kind"])
        action = F.when(turned, unsafe.action).otherwise(fact["action"])
        counted = F.concat(  # fixed value: the suffix
            fact["details"], F.lit(" ("), fact["bad"].cast("string"), F.lit(" unparseable values)")
        )
        return F.struct(
            anomaly_id(run_id, entity, kind, fact["field"]),
            run_id,
            kind,
            F.when(turned, unsafe.severity).otherwise(fact["severity"]),
            entity,
            fact["field"],
            as_of,
            F.when(turned, counted).otherwise(fact["details"]),
            action,
            action,
            F.coalesce(fact["moved"], F.lit(0).cast("bigint")),
            fact["acted"],
        )

    return F.transform(facts, entry).cast(_ENTRIES)


def assess(
    df: DataFrame, contract: Contract, run_id, as_of, probe: str = "numeric"
) -> DataFrame:
    """One row per run: its row counts, and its anomalies with their actions, in one pass.

    ``run_id`` and ``as_of`` are texts for a single batch, or columns of ``df`` when it
    holds the batches of many runs.
    """
    df = apart(df, contract.schema.names)
    findings = compare_schema(df.schema, contract, probe)
    tests = bad_value_tests(findings)
    counts = count_columns(flags(tests))
    aggregates = [column.alias(f"_{name}") for name, column in counts.items()]
    if isinstance(run_id, Column) or isinstance(as_of, Column):
        keys = [as_column(run_id).alias("_run"), as_column(as_of).alias("_as_of")]
        counted = df.select(*keys, *flag_columns(tests)).groupBy("_run", "_as_of").agg(*aggregates)
        run_id, as_of = F.col("_run"), F.col("_as_of")
    else:
        counted = df.select(*flag_columns(tests)).agg(*aggregates)
        run_id, as_of = F.lit(run_id), F.lit(as_of)
    seen = {name: F.col(f"_{name}") for name in counts}
    return counted.select(*outcome_columns(findings, contract, run_id, as_of, seen))


def _unfold(assessed: DataFrame) -> DataFrame:
    # Not a plain inline: for that Spark infers a test for empty arrays and, where entries hang
    # on the run alone, moves it below the aggregate, building the entries for every input row.
    unfolded = assessed.select(F.inline_outer("anomalies"))
    return unfolded.filter(F.col("anomaly_id").isNotNull())


def anomalies_of(assessed: DataFrame) -> DataFrame:
    """Anomaly rows of the runs in ``assessed``."""
    return _unfold(assessed).select(*ANOMALY_FIELDS)


def actions_of(assessed: DataFrame) -> DataFrame:
    """Action rows of the runs in ``assessed``: what was done and how many rows it moved."""
    return _unfold(assessed).filter("acted").select(*ACTION_FIELDS)


def detect(df: DataFrame, contract: Contract, run_id, as_of, probe: str = "numeric") -> DataFrame:
    """The anomalies of a batch, or of every run in it; see :func:`assess`.

    A single batch is read only if a retyped column must be tested. The probe goes along as metadata of
    the column ``field``, so that ``heal`` tests for what was found.
    """
    found = _detected(df, contract, run_id, as_of, probe)
    return found.withMetadata("field", {PROBE: probe})


def _detected(df, contract, run_id, as_of, probe) -> DataFrame:
    df = apart(df, contract.schema.names)
    findings = compare_schema(df.schema, contract, probe)
    many_runs = isinstance(run_id, Column) or isinstance(as_of, Column)
    if many_runs or any(f.probe is not None for f in findings):
        return anomalies_of(assess(df, contract, run_id, as_of, probe))
    unread = {"rows_total": F.lit(None).cast("bigint"), "rows_bad": F.lit(None).cast("bigint")}
    columns = outcome_columns(findings, contract, F.lit(run_id), F.lit(as_of), unread)
    return anomalies_of(df.sparkSession.range(1, numPartitions=1).select(*columns))


def in_report_order(anomalies: DataFrame) -> DataFrame:
    """Anomalies by run in the order added, removed, retyped, then field name."""
    rank = F.create_map(*[F.lit(x) for pair in KIND_ORDER.items() for x in pair])
    return anomalies.orderBy("run_id", rank[F.col("anomaly_type")], "field")
