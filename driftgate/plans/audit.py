"""Run records and incident summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.functions.columns import as_column
from driftgate.functions.text import severity_rank, summary_text

# Columns of a summary; the pipeline log adds the path of the drifted batch.
SUMMARY_FIELDS = (
    "run_id", "entity", "drift_type", "force_critical", "anomaly_count", "max_severity",
    "rows_quarantined", "rows_surviving", "summary_text", "completed_at",
)


def run_records(
    assessed: DataFrame, drift_type=None, force_critical=None, drifted_path=None
) -> DataFrame:
    """The pipeline-log row of each run in ``assessed``.

    A run's worst severity is judged by rank, and is ``NONE`` if nothing was found.
    """
    found = F.col("anomalies")
    ranked = F.transform(
        found, lambda a: F.struct(severity_rank(a["severity"]).alias("rank"), a["severity"].alias("s"))
    )
    n = F.size(found).cast("bigint")

    def distinct(name: str):
        return F.array_sort(F.array_distinct(F.transform(found, lambda a: a[name])))

    columns = {
        "run_id": F.col("run_id"),
        "entity": F.col("entity"),
        "drift_type": as_column(drift_type).cast("string"),
        "force_critical": as_column(force_critical).cast("boolean"),
        "anomaly_count": n,
        "max_severity": F.coalesce(F.array_max(ranked)["s"], F.lit("NONE")),
        "rows_quarantined": F.col("rows_quarantined"),
        "rows_surviving": F.col("rows_surviving"),
        "summary_text": summary_text(
            F.col("entity"), F.col("run_id"), n,
            distinct("anomaly_type"), distinct("severity"), distinct("field"),
        ),
        "completed_at": F.col("detected_at"),
        "drifted_path": as_column(drifted_path).cast("string"),
    }
    return assessed.select(*[c.alias(name) for name, c in columns.items()])


def summarize_log(anomalies: DataFrame) -> DataFrame:
    """Per run of an anomaly log: how many anomalies, how bad, of which kinds, in words.

    The sets hold at most one entry per kind, severity and column of the dataset.
    """
    grouped = anomalies.groupBy("run_id", "entity").agg(
        F.count(F.lit(1)).alias("anomaly_count"),
        F.max_by("severity", severity_rank(F.col("severity"))).alias("max_severity"),
        F.array_sort(F.collect_set("anomaly_type")).alias("types"),
        F.array_sort(F.collect_set("severity")).alias("severities"),
        F.array_sort(F.collect_set("field")).alias("fields"),
    )
    text = summary_text(
        F.col("entity"), F.col("run_id"), F.col("anomaly_count"),
        F.col("types"), F.col("severities"), F.col("fields"),
    )
    return grouped.withColumn("summary_text", text)
