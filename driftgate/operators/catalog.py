"""Schema comparison over rows instead of schemas, for many datasets at once.

A catalog of observed columns, gathered from any number of batches, is matched by
name with the expected columns in one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.functions.columns import count_where, quoted, zipped
from driftgate.functions.text import type_name
from driftgate.operators.detect import bad_value_tests, compare_schema, flag_columns, flags
from driftgate.settings import (
    ADDED,
    REMOVED,
    REMOVED_CRITICAL,
    RETYPED_SAFE,
    RETYPED_UNSAFE,
    RULES,
)
from driftgate.sources.contracts import Contract
from driftgate.sources.tables import local_frame


def rule_frame(spark: SparkSession) -> DataFrame:
    """The action matrix as rows."""
    rows = [(r.anomaly_type, r.severity, r.action) for r in RULES.values()]
    return local_frame(spark, dict.fromkeys(("anomaly_type", "severity", "action"), "string"), rows)


def schema_rows(df: DataFrame, entity: str, contract: Contract | None = None) -> DataFrame:
    """Columns of a batch as rows: type, rows, values, and values that no longer parse.

    One aggregate over the batch; values are tested only where ``contract`` calls for it.
    """
    findings = compare_schema(df.schema, contract) if contract else []
    tests = bad_value_tests(findings)
    fields = [f for f in df.schema.fields if not f.name.startswith("_")]
    flagged = df.select(*[quoted(f.name) for f in fields], *flag_columns(tests))
    counted = flagged.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.expr(f"count({quoted(f.name)})").alias(f"values_{i}") for i, f in enumerate(fields)],
        *[count_where(flag).alias(f"bad_{i}") for i, flag in enumerate(flags(tests).values())],
    )
    bad = {name: F.col(f"bad_{i}") for i, name in enumerate(tests)}
    columns = zipped(
        entity=[entity] * len(fields),
        position=range(1, len(fields) + 1),
        field=[f.name for f in fields],
        type=[type_name(f.dataType) for f in fields],
        n_rows=[F.col("rows")] * len(fields),
        n_values=[F.col(f"values_{i}") for i in range(len(fields))],
        n_unparseable=[bad.get(f.name, F.lit(0).cast("bigint")) for f in fields],
    )
    return counted.select(F.inline(columns))


def diff_schema_rows(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Differences between expected columns and observed ones, with severity and action.

    ``expected`` is as ``contract_rows`` makes it, ``observed`` as :func:`schema_rows` does.
    Both have one row per column of a dataset, so the join stays small whatever the data.
    """
    joined = expected.join(observed, ["entity", "field"], "full_outer")
    changed = F.col("expected_type") != F.col("type")
    kind = (
        F.when(F.col("expected_type").isNull(), ADDED)
        .when(F.col("type").isNull() & F.col("critical"), REMOVED_CRITICAL)
        .when(F.col("type").isNull(), REMOVED)
        .when(changed & (F.col("n_unparseable") > 0), RETYPED_UNSAFE)
        .when(changed, RETYPED_SAFE)
    )
    found = joined.withColumn("anomaly_type", kind).filter(F.col("anomaly_type").isNotNull())
    # The matrix has one row per anomaly type, a fixed handful.
    rules = F.broadcast(rule_frame(expected.sparkSession))
    return found.join(rules, "anomaly_type").select(
        "entity", "field", "anomaly_type", "severity", "action",
        F.col("expected_type"), F.col("type").alias("actual_type"), "n_unparseable",
    )
