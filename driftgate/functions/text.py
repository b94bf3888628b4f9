"""Texts and ranks shown to people reading the logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftgate.functions.columns import as_column
from driftgate.settings import SEVERITIES


def type_name(data_type: T.DataType) -> str:
    """Readable name of a type, ignoring nullability at every level."""
    named = data_type.jsonValue()
    return named if isinstance(named, str) else data_type.simpleString()


def severity_rank(severity: Column) -> Column:
    """Position of a severity from mildest (1) to worst; 0 if unknown."""
    return F.array_position(F.array(*map(F.lit, SEVERITIES)), severity).cast("int")


def quoted_list(items: Column) -> Column:
    """An array of strings as ``['a', 'b']``."""
    return F.concat(F.lit("['"), F.array_join(items, "', '"), F.lit("']"))


def summary_text(entity, run_id, n: Column, types: Column, severities: Column, fields: Column) -> Column:
    """Incident text of one run; ``types``, ``severities`` and ``fields`` are sorted arrays."""
    entity, run_id = as_column(entity), as_column(run_id)
    # The two templates.
    quiet = F.concat(
        F.lit("No schema drift detected for "), entity, F.lit(" in run "), run_id, F.lit(".")
    )
    drifted = F.concat(
        F.lit("Schema drift in "), entity, F.lit(" (run "), run_id, F.lit("). "),
        n.cast("string"), F.lit(" event(s) of types "), quoted_list(types),
        F.lit(" at severity "), quoted_list(severities),
        F.lit(". Affected fields: "), quoted_list(fields),
        F.lit(". Healing actions were applied per the HEALING_ACTION_MATRIX."),
    )
    return F.when(n > 0, drifted).otherwise(quiet)
