"""Queries of contracts that change over time and of columns that hold columns."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftgate.functions import hash_bucket
from driftgate.operators import detect, detect_as_of, heal, retype_to_string
from driftgate.sources import Contract, snapshot_frame
from workload.registry import query
from workload.tables import (
    DAY_END,
    DAY_RUN,
    EVENT_KEY,
    EVENTS,
    EVENTS_DRIFTED,
    bad_sql,
    bucket_sql,
    corrupt_sql,
    day_end,
    day_run,
    detect_sql,
    events_drifted,
    table,
)

AS_OF = "2024-01-31 12:00:00"

# -- contracts by time -----------------------------------------------------------


def _versions(spark):
    """Three versions of one contract: at first the value is text and there are no props, then the value is a number, then
    props are agreed as well. The second is saved twice, once with a lower number."""
    without = T.StructType([f for f in EVENTS.schema.fields if f.name != "props"])
    text = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "value" else f for f in without.fields])
    saved = (
        (text, "2023-12-01 00:00:00", "9.0"), (text, "2024-01-10 12:00:00", "9.1"), (without, "2024-01-10 12:00:00", "10.0"),
        (EVENTS.schema, "2024-01-20 23:59:59", "11.0"),
    )
    frames = [snapshot_frame(spark, [replace(EVENTS, schema=schema)], since, n) for schema, since, n in saved]
    return frames[0].union(frames[1]).union(frames[2]).union(frames[3])


@query(f"""
SELECT * FROM ({detect_sql("events", EVENTS_DRIFTED, DAY_RUN, DAY_END, ("value",))})
WHERE field = 'loyalty_tier' OR (field = 'value' AND detected_at >= '2024-01-10 12:00:00')
    OR (field = 'props' AND detected_at >= '2024-01-20 23:59:59')
""", name="detect_as_of")
def detected_as_of(spark, sf_dir):
    """Every day's batch judged by the contract that was in force on that day."""
    return detect_as_of(events_drifted(spark, sf_dir), _versions(spark), "events", day_run(), day_end())


# -- nested columns ----------------------------------------------------------------

_NESTED = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("payload", T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("amount", T.DoubleType()), T.StructField("note", T.StringType()),
    ])),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType()),
    ]))),
    T.StructField("tags", T.MapType(T.StringType(), T.DoubleType())),
])
NESTED = Contract.of("nested_events", _NESTED, ("event_id",), ("event_id",))
_AMOUNT, _TAG = corrupt_sql("value", EVENT_KEY), corrupt_sql("value", EVENT_KEY, 44)


def _nested(spark, sf_dir):
    """Events as the contract has them nested, but for a field too many, one too few, and numbers as text."""
    events = table(spark, sf_dir, "events").withColumns({"amount": F.col("value"), "tag": F.col("value")})
    for name, salt in (("amount", 42), ("tag", 44)):
        events = retype_to_string(events, name, EVENTS.key, corrupt=True, salt=salt)
    text = F.col("value").cast("string")
    return events.select(
        "event_id",
        F.struct(F.lit("GOLD").alias("tier"), "amount", F.col("event_type").alias("kind")).alias("payload"),
        F.array(F.struct(F.col("user_id").alias("id"), text.alias("price"), F.lit(1).alias("n"))).alias("items"),
        F.create_map(F.lit("value"), F.col("tag"), F.lit("none"), F.lit(None).cast("string")).alias("tags"),
    )


@query(f"""
SELECT field, 'schema_drift_' || kind AS anomaly_type, severity, action, details
FROM (
    SELECT count(*) FILTER (WHERE {bad_sql(f"({_AMOUNT})")}) AS a, count(*) FILTER (WHERE {bad_sql(f"({_TAG})")}) AS t
    FROM events) c
CROSS JOIN LATERAL (VALUES
    ('payload.tier', 'column_added', 'LOW', 'drop_added_column', 'Unexpected new column ''payload.tier'' (string).'),
    ('items.element.n', 'column_added', 'LOW', 'drop_added_column', 'Unexpected new column ''items.element.n'' (integer).'),
    ('payload.note', 'column_removed_non_critical', 'MEDIUM', 'fill_null_and_warn',
        'Expected column ''payload.note'' missing from source.'),
    ('payload.amount', 'type_change_unsafe', 'CRITICAL', 'quarantine_affected_records',
        'Type drift on ''payload.amount'': expected double, got string (' || a || ' unparseable values)'),
    ('items.element.price', 'type_change_safe', 'MEDIUM', 'cast_and_warn',
        'Type drift on ''items.element.price'': expected double, got string'),
    ('tags.value', 'type_change_unsafe', 'CRITICAL', 'quarantine_affected_records',
        'Type drift on ''tags.value'': expected double, got string (' || t || ' unparseable values)')
) v(field, kind, severity, action, details)
""")
def detect_nested(spark, sf_dir):
    """Drift inside a struct, an array of structs and a map."""
    found = detect(_nested(spark, sf_dir), NESTED, "run_nested", AS_OF)
    return found.select("field", "anomaly_type", "severity", "action", "details")


@query(f"""
SELECT event_id, event_type AS kind, value AS amount, NULL::VARCHAR AS note, user_id AS id, value AS price, value AS tag
FROM events WHERE NOT {bad_sql(f"({_AMOUNT})")} AND NOT {bad_sql(f"({_TAG})")}
""")
def heal_nested(spark, sf_dir):
    """The rows that pass, rebuilt in the contract's shape and types."""
    batch = _nested(spark, sf_dir)
    healed = heal(batch, NESTED, detect(batch, NESTED, "run_nested", AS_OF), on_safe="cast")
    item = F.element_at("items", 1)
    return healed.clean.select("event_id", "payload.*", item["id"].alias("id"), item["price"].alias("price"),
                               F.col("tags")["value"].alias("tag"))


# -- what detection finds is what is held back ---------------------------------------

_INTEGERS = Contract.of("visits", "event_id bigint not null, visitor int", ("event_id",), ("event_id",))
_BUCKET = bucket_sql(EVENT_KEY, 42)
_VISITOR = f"""CASE WHEN {_BUCKET} < 500 THEN '2.5' WHEN {_BUCKET} < 1000 THEN '99999999999' WHEN {_BUCKET} < 1500 THEN 'x'
    ELSE user_id::VARCHAR END"""


@query(f"""
SELECT event_id, {_VISITOR} AS visitor, 'unparseable:visitor' AS _quarantine_reason FROM events WHERE {_BUCKET} < 1500
""")
def quarantine_integers(spark, sf_dir):
    """Text where an integer is expected, tested exactly: fractions and numbers too large are held back too."""
    bucket = hash_bucket(EVENTS.key, 42)
    text = F.when(bucket < 500, "2.5").when(bucket < 1000, "99999999999").when(bucket < 1500, "x")
    batch = table(spark, sf_dir, "events").select(
        "event_id", F.coalesce(text, F.col("user_id").cast("string")).alias("visitor")
    )
    healed = heal(batch, _INTEGERS, detect(batch, _INTEGERS, "run_visits", AS_OF, probe="all"))
    return healed.quarantine.select("event_id", "visitor", "_quarantine_reason")
