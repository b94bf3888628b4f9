"""Queries over the events as a stream; each drains what is there and reads back the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.functions import hash_bucket
from driftgate.operators import retype_to_string
from driftgate.sources import Contract, workspace
from driftgate.streaming import (
    close_windows,
    count_windows,
    gate,
    gate_files,
    read_gate,
    read_gate_anomalies,
    read_gate_log,
    read_closed,
    read_late,
    read_open,
    read_windows,
)
from workload.registry import query
from workload.tables import EVENT_KEY, EVENTS, EVENTS_UNSAFE, bad_sql, bucket_sql, table


def _event_stream(spark, sf_dir) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # As a pattern, the path may be one file or a folder of many.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def _gated(spark, sf_dir) -> str:
    root = workspace(spark, "gate")
    stream = retype_to_string(_event_stream(spark, sf_dir), "value", EVENTS.key, corrupt=True)
    gate(stream, EVENTS, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


@query(f"""
SELECT event_id, value, 'unparseable:value' AS _quarantine_reason
FROM ({EVENTS_UNSAFE}) WHERE {bad_sql("value")}
""", name="stream_gate")
def stream_quarantine(spark, sf_dir):
    held = read_gate(spark, _gated(spark, sf_dir), "quarantine")
    return held.select("event_id", "value", "_quarantine_reason")


@query(f"""
SELECT event_id, ts, user_id, event_type, value, props
FROM ({EVENTS_UNSAFE}) WHERE NOT {bad_sql("value")}
""")
def stream_clean(spark, sf_dir):
    return read_gate(spark, _gated(spark, sf_dir), "clean").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"
    )


@query(f"""
SELECT count(*) AS rows_total, count(*) FILTER (WHERE {bad_sql("value")}) AS rows_quarantined
FROM ({EVENTS_UNSAFE})
""")
def stream_gate_log(spark, sf_dir):
    log = read_gate_log(spark, _gated(spark, sf_dir))
    return log.groupBy().sum("rows_total", "rows_quarantined").toDF("rows_total", "rows_quarantined")


@query(f"""
SELECT field, anomaly_type, severity, action
FROM (VALUES ('value', 'schema_drift_type_change_unsafe', 'CRITICAL', 'quarantine_affected_records'))
    t(field, anomaly_type, severity, action)
WHERE EXISTS (SELECT 1 FROM ({EVENTS_UNSAFE}) WHERE {bad_sql("value")})
""")
def stream_anomalies(spark, sf_dir):
    """What the gate found, over all micro-batches."""
    found = read_gate_anomalies(spark, _gated(spark, sf_dir))
    return found.select("field", "anomaly_type", "severity", "action").distinct()


@query("""
SELECT event_id, CASE WHEN day(ts) <= 15 THEN value END AS value,
    CASE WHEN day(ts) <= 15 THEN 'clean' ELSE 'missing:value' END AS outcome
FROM events
""")
def stream_drift(spark, sf_dir):
    """A stream whose later files come without a critical column and with one nobody expects."""
    root, events = workspace(spark, "drifting"), table(spark, sf_dir, "events")
    early, landing = F.dayofmonth("ts") <= 15, f"{root}/landing"
    events.filter(early).write.parquet(landing)
    changed = events.filter(~early).drop("value").withColumn("tier", F.lit("GOLD"))
    changed.write.mode("append").parquet(landing)
    stream = spark.readStream.schema(events.schema).parquet(landing)
    gate(stream, EVENTS, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    kept, held = (read_gate(spark, f"{root}/out", part) for part in ("clean", "quarantine"))
    return kept.select("event_id", "value", F.lit("clean").alias("outcome")).union(
        held.select("event_id", "value", F.col("_quarantine_reason").alias("outcome"))
    )


@query("""
SELECT date_trunc('day', ts)::TIMESTAMP AS window_start,
    date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n_rows
FROM events GROUP BY ALL
""")
def stream_volume(spark, sf_dir):
    root = workspace(spark, "windows")
    started = count_windows(
        _event_stream(spark, sf_dir), "ts", f"{root}/out", f"{root}/checkpoint", by=["event_type"]
    )
    started.awaitTermination()
    return read_windows(spark, f"{root}/out")


# The critical value may be null, so only the files' own schemas tell that it is gone.
LOOSE_EVENTS = Contract.of(
    "events",
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double?, props string?",
    critical=("event_id", "value"),
    key=("event_id",),
)


def _drifting_files(spark, sf_dir) -> str:
    """A stream whose files change from one to the next: as agreed, without the value, then with it as text and one
    column more."""
    root, events = workspace(spark, "drifting-files"), table(spark, sf_dir, "events")
    day, landing = F.dayofmonth("ts"), f"{root}/landing"
    junk = retype_to_string(events.filter(day > 20), "value", EVENTS.key, corrupt=True)
    for i, part in enumerate((
        events.filter(day <= 10), events.filter(day.between(11, 20)).drop("value"), junk.withColumn("tier", F.lit("GOLD")),
    )):
        part.write.mode("append").parquet(landing)
        if i != 1:  # the first alone, the others in one micro-batch
            gate_files(spark, landing, LOOSE_EVENTS, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


_LATE_VALUE = f"(SELECT * FROM ({EVENTS_UNSAFE}) WHERE day(ts) > 20)"


@query(f"""
SELECT event_id, value, 'clean' AS outcome FROM events WHERE day(ts) <= 10
UNION ALL SELECT event_id, NULL, 'full_batch:schema_drift_column_removed_critical' FROM events WHERE day(ts) BETWEEN 11 AND 20
UNION ALL SELECT event_id, TRY_CAST(value AS DOUBLE), CASE WHEN {bad_sql("value")} THEN 'unparseable:value' ELSE 'clean' END
FROM {_LATE_VALUE}
""")
def stream_drift_files(spark, sf_dir):
    """Each file of a stream judged by its own schema."""
    root = _drifting_files(spark, sf_dir)
    kept, held = (read_gate(spark, root, part) for part in ("clean", "quarantine"))
    return kept.select("event_id", "value", F.lit("clean").alias("outcome")).union(
        held.select("event_id", "value", F.col("_quarantine_reason").alias("outcome"))
    )


@query(f"""
SELECT 'value' AS field, 'schema_drift_column_removed_critical' AS anomaly_type, 'CRITICAL' AS severity,
    'quarantine_batch' AS action, 'Expected column ''value'' missing from source.' AS details
UNION ALL SELECT 'tier', 'schema_drift_column_added', 'LOW', 'drop_added_column', 'Unexpected new column ''tier'' (string).'
UNION ALL SELECT 'value', 'schema_drift_type_change_unsafe', 'CRITICAL', 'quarantine_affected_records',
    'Type drift on ''value'': expected double, got string (' || count(*) || ' unparseable values)'
FROM {_LATE_VALUE} WHERE {bad_sql("value")}
""")
def stream_drift_anomalies(spark, sf_dir):
    """What the gate found in the files of a stream."""
    found = read_gate_anomalies(spark, _drifting_files(spark, sf_dir))
    return found.select("field", "anomaly_type", "severity", "action", "details")


_FIRST = f"ts < '2024-01-20' AND NOT (day(ts) <= 5 AND {bucket_sql(EVENT_KEY, 42)} < 1000)"


@query(f"""
WITH arrived AS (SELECT *, {_FIRST} AS first FROM events),
marks AS (
    SELECT max(ts) FILTER (WHERE first) - INTERVAL 2 DAY AS one, max(ts) - INTERVAL 2 DAY AS two FROM arrived),
counted AS (
    SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type,
        NOT first AND date_trunc('day', ts) + INTERVAL 1 DAY <= one AS late, two
    FROM arrived, marks)
SELECT window_start, event_type, count(*) FILTER (WHERE NOT late) AS n_rows, count(*) FILTER (WHERE late) AS n_late,
    CASE WHEN window_start + INTERVAL 1 DAY <= any_value(two) THEN 'closed' ELSE 'open' END AS state
FROM counted GROUP BY window_start, event_type
""")
def stream_late_rows(spark, sf_dir):
    """Events by day and type; some of the first days' come weeks later, when their windows are closed."""
    root, events = workspace(spark, "late"), table(spark, sf_dir, "events")
    landing = f"{root}/landing"
    held = (F.dayofmonth("ts") <= 5) & (hash_bucket(EVENTS.key, 42) < 1000)
    first = (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")) & ~held
    for part in (events.filter(first), events.filter(~first)):
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.schema).parquet(landing)
        close_windows(
            stream, "ts", f"{root}/out", f"{root}/checkpoint", lateness="2 days", by=["event_type"]
        ).awaitTermination()
    keys = ["window_start", "event_type"]
    states = read_closed(spark, f"{root}/out").select(*keys, "n_rows", F.lit("closed").alias("state")).union(
        read_open(spark, f"{root}/out").select(*keys, "n_rows", F.lit("open").alias("state"))
    )
    late = read_late(spark, f"{root}/out").select(*keys, "n_late")
    return states.join(late, keys, "left").select(*keys, "n_rows", F.coalesce("n_late", F.lit(0)).alias("n_late"), "state")
