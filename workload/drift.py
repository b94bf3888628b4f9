"""Queries of scans, drills, contracts, detection and repair."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.functions import anomaly_id, sanitize_run_id
from driftgate.operators import (
    add_column,
    assess,
    detect,
    diff_schema_rows,
    drill,
    drop_column,
    heal,
    retype_to_string,
    schema_rows,
)
from driftgate.operators.detect import actions_of
from driftgate.settings import DRILLS
from driftgate.sources import CONTRACTS, contract_rows, latest_by, latest_snapshots
from workload.entities import BASELINES
from workload.registry import query
from workload.tables import (
    CUSTOMER,
    DAY_END,
    DAY_RUN,
    EVENTS,
    EVENTS_DRIFTED,
    EVENTS_UNSAFE,
    LINE_KEY,
    LINEITEM,
    LINE_SALTS,
    MONTH_END,
    MONTH_RUN,
    NATION_END,
    NATION_RUN,
    ORDERS,
    TABLE_CONTRACTS,
    TABLE_DRILLS,
    TYPE_SQL,
    anomalies_sql,
    bad_sql,
    corrupt_sql,
    day_end,
    day_run,
    detect_sql,
    events_drifted,
    events_unsafe,
    lines_unsafe,
    month_end,
    month_run,
    nation_run,
    table,
)

AS_OF = "2024-01-31 12:00:00"

# -- scans and drills ----------------------------------------------------------


@query("SELECT event_id, event_type, value FROM events")
def scan_baseline(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type", "value")


def _drilled(spark, sf_dir, name: str, kind: str, force: bool = False) -> DataFrame:
    key = TABLE_CONTRACTS[name].key
    return drill(table(spark, sf_dir, name), TABLE_DRILLS[name], kind, key, force).df


@query("SELECT *, 750 AS credit_score FROM orders")
def mutate_add_column(spark, sf_dir):
    return _drilled(spark, sf_dir, "orders", "column_added")


@query("SELECT * EXCLUDE (props) FROM events")
def mutate_drop_noncritical(spark, sf_dir):
    return _drilled(spark, sf_dir, "events", "column_removed")


@query("SELECT * EXCLUDE (value) FROM events")
def mutate_drop_critical(spark, sf_dir):
    return _drilled(spark, sf_dir, "events", "column_removed", force=True)


@query("SELECT * REPLACE (c_nationkey::VARCHAR AS c_nationkey) FROM customer")
def mutate_retype_safe(spark, sf_dir):
    return _drilled(spark, sf_dir, "customer", "type_changed")


@query(EVENTS_UNSAFE)
def mutate_retype_unsafe(spark, sf_dir):
    return _drilled(spark, sf_dir, "events", "type_changed")


# -- contracts -------------------------------------------------------------------


def _schema_rows_sql(
    name: str, batch: str, lacks: str = "", gains: str = "", tested: tuple[str, ...] = ()
) -> str:
    """Columns of a batch of a table that lacks one of its columns, or gains one."""
    fields = [f.name for f in TABLE_CONTRACTS[name].schema.fields if f.name != lacks]
    counts = " UNION ALL ".join(
        f"SELECT '{f}' AS field, count(*) AS n_rows, count({f}) AS n_values, "
        + (f"count(*) FILTER (WHERE {bad_sql(f)})" if f in tested else "0::BIGINT")
        + f" AS n_unparseable FROM ({batch})"
        for f in fields + [gains] * bool(gains)
    )
    return f"""
    SELECT '{name}' AS entity, position, c.field, d.type, n_rows, n_values, n_unparseable
    FROM ({counts}) c
    JOIN (SELECT column_name AS field, {TYPE_SQL} AS type,
                 (row_number() OVER ())::INTEGER AS position FROM (DESCRIBE {batch})) d
        ON c.field = d.field"""


@query(
    " UNION ALL ".join(_schema_rows_sql(n, f"SELECT * FROM {n}") for n in TABLE_CONTRACTS),
    name="schema_rows",
)
def schema_catalog(spark, sf_dir):
    rows = [schema_rows(table(spark, sf_dir, name), name) for name in TABLE_CONTRACTS]
    return reduce(DataFrame.unionByName, rows)


_OBSERVED = {
    "events": _schema_rows_sql(
        "events", f"SELECT * EXCLUDE (props) FROM ({EVENTS_UNSAFE})", lacks="props", tested=("value",)
    ),
    "orders": _schema_rows_sql(
        "orders", "SELECT *, 750 AS credit_score FROM orders", gains="credit_score"
    ),
    "customer": _schema_rows_sql(
        "customer", "SELECT * EXCLUDE (c_acctbal) FROM customer", lacks="c_acctbal"
    ),
}
_EXPECTED_SQL = " UNION ALL ".join(
    f"""SELECT '{n}' AS entity, column_name AS field, {TYPE_SQL} AS expected_type,
        column_name IN ({", ".join(f"'{c}'" for c in sorted(TABLE_CONTRACTS[n].critical))}) AS critical
        FROM (DESCRIBE SELECT * FROM {n})"""
    for n in _OBSERVED
)


@query(f"""
SELECT entity, field, anomaly_type, expected_type, type AS actual_type, n_unparseable,
    CASE anomaly_type WHEN 'schema_drift_column_added' THEN 'LOW'
        WHEN 'schema_drift_column_removed_non_critical' THEN 'MEDIUM'
        WHEN 'schema_drift_type_change_safe' THEN 'MEDIUM' ELSE 'CRITICAL' END AS severity,
    CASE anomaly_type WHEN 'schema_drift_column_added' THEN 'drop_added_column'
        WHEN 'schema_drift_column_removed_non_critical' THEN 'fill_null_and_warn'
        WHEN 'schema_drift_column_removed_critical' THEN 'quarantine_batch'
        WHEN 'schema_drift_type_change_safe' THEN 'cast_and_warn'
        ELSE 'quarantine_affected_records' END AS action
FROM (
    SELECT coalesce(e.entity, o.entity) AS entity, coalesce(e.field, o.field) AS field,
        e.expected_type, o.type, o.n_unparseable,
        CASE WHEN e.field IS NULL THEN 'schema_drift_column_added'
             WHEN o.field IS NULL AND e.critical THEN 'schema_drift_column_removed_critical'
             WHEN o.field IS NULL THEN 'schema_drift_column_removed_non_critical'
             WHEN o.n_unparseable > 0 THEN 'schema_drift_type_change_unsafe'
             ELSE 'schema_drift_type_change_safe' END AS anomaly_type
    FROM ({_EXPECTED_SQL}) e
    FULL JOIN ({" UNION ALL ".join(_OBSERVED.values())}) o
        ON e.entity = o.entity AND e.field = o.field
    WHERE e.expected_type IS DISTINCT FROM o.type)
""")
def schema_diff(spark, sf_dir):
    batches = {
        "events": drop_column(events_unsafe(spark, sf_dir), "props"),
        "orders": add_column(table(spark, sf_dir, "orders"), "credit_score", "int", 750),
        "customer": drop_column(table(spark, sf_dir, "customer"), "c_acctbal"),
    }
    observed = [schema_rows(df, n, TABLE_CONTRACTS[n]) for n, df in batches.items()]
    expected = contract_rows(spark, [TABLE_CONTRACTS[n] for n in batches])
    return diff_schema_rows(expected, reduce(DataFrame.unionByName, observed))


@query("""
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_snapshot(spark, sf_dir):
    return latest_by(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


@query("""
WITH saved AS (
    SELECT event_type AS entity_name, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS snapshot_timestamp,
        hour(ts)::VARCHAR || '.' || minute(ts)::VARCHAR AS version, hour(ts) AS major, minute(ts) AS minor
    FROM events GROUP BY ALL)
SELECT entity_name, snapshot_timestamp, version FROM saved
QUALIFY row_number() OVER (
    PARTITION BY entity_name ORDER BY snapshot_timestamp DESC, major DESC, minor DESC) = 1
""")
def latest_versions(spark, sf_dir):
    """The snapshot in force where many share a second, so that only the version as a number tells."""
    saved = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("entity_name"),
        F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd HH:mm:ss").alias("snapshot_timestamp"),
        F.concat_ws(".", F.hour("ts"), F.minute("ts")).alias("version"),
    ).distinct()
    return latest_snapshots(saved)


@query("""
SELECT c_custkey, c_nationkey::VARCHAR AS c_nationkey FROM customer
""")
def heal_case_twin(spark, sf_dir):
    """A batch with a column that differs from an expected one only in case: that one is dropped."""
    batch = table(spark, sf_dir, "customer").withColumn("c_nationkey", F.col("c_nationkey").cast("string"))
    names = [*batch.columns, "C_NATIONKEY"]
    twin = batch.withColumn("_twin", F.lit("junk")).toDF(*names)
    healed = heal(twin, CUSTOMER, detect(twin, CUSTOMER, "run_twin", AS_OF))
    return healed.clean.select("c_custkey", "c_nationkey")


@query("""
WITH given AS (
    SELECT event_id, event_type || ' #' || event_id::VARCHAR || '/' || props || '~é-' || ts::VARCHAR AS raw FROM events),
made AS (SELECT *, regexp_replace(raw, '[^A-Za-z0-9_]', '_', 'g') AS safe FROM given)
SELECT event_id, 'run_' || substr(safe, 1, 40)
    || CASE WHEN safe = raw AND length(raw) <= 40 THEN '' ELSE '_' || substr(md5(raw), 1, 8) END AS run_id
FROM made
""")
def run_id_sanitize(spark, sf_dir):
    raw = F.concat(
        "event_type", F.lit(" #"), F.col("event_id").cast("string"), F.lit("/"), "props",
        F.lit("~é-"), F.col("ts").cast("string"),
    )
    return table(spark, sf_dir, "events").select("event_id", sanitize_run_id(raw).alias("run_id"))


@query(f"""
SELECT event_id, sha256({DAY_RUN} || '|events|' || event_type || '|' || props) AS anomaly_id
FROM events
""")
def anomaly_id_hash(spark, sf_dir):
    named = anomaly_id(day_run(), "events", F.col("event_type"), F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", named.alias("anomaly_id"))


# -- detection ---------------------------------------------------------------------


@query(detect_sql("orders", "SELECT *, 750 AS credit_score FROM orders", MONTH_RUN, MONTH_END))
def detect_added(spark, sf_dir):
    return detect(mutate_add_column(spark, sf_dir), ORDERS, month_run(), month_end())


@query(detect_sql("events", "SELECT * EXCLUDE (props) FROM events", DAY_RUN, DAY_END))
def detect_removed_noncritical(spark, sf_dir):
    return detect(mutate_drop_noncritical(spark, sf_dir), EVENTS, day_run(), day_end())


@query(detect_sql("customer", "SELECT * EXCLUDE (c_acctbal) FROM customer", NATION_RUN, NATION_END))
def detect_removed_critical(spark, sf_dir):
    batch = _drilled(spark, sf_dir, "customer", "column_removed", force=True)
    return detect(batch, CUSTOMER, nation_run(), "2024-01-15 00:00:00")


@query(detect_sql(
    "customer", "SELECT * REPLACE (c_nationkey::VARCHAR AS c_nationkey) FROM customer",
    "'run_' || c_mktsegment", f"'{AS_OF}'", ("c_nationkey",),
))
def detect_retype_safe(spark, sf_dir):
    run = F.concat(F.lit("run_"), F.col("c_mktsegment"))
    return detect(mutate_retype_safe(spark, sf_dir), CUSTOMER, run, AS_OF)


@query(detect_sql(
    "events", "SELECT * REPLACE (ts::VARCHAR AS ts) FROM events", "'run_' || event_type", f"'{AS_OF}'"
))
def detect_retype_untested(spark, sf_dir):
    """A timestamp that arrives as text counts as safe: only numbers are tested."""
    batch = retype_to_string(table(spark, sf_dir, "events"), "ts")
    return detect(batch, EVENTS, F.concat(F.lit("run_"), F.col("event_type")), AS_OF)


@query(detect_sql("events", EVENTS_UNSAFE, DAY_RUN, DAY_END, ("value",)))
def detect_retype_unsafe(spark, sf_dir):
    return detect(events_unsafe(spark, sf_dir), EVENTS, day_run(), day_end())


_DATES = f"SELECT * REPLACE ({corrupt_sql('o_orderdate', 'o_orderkey::VARCHAR')} AS o_orderdate) FROM orders"


@query(f"""
SELECT 'run_' || o_orderstatus AS run_id, 'o_orderdate' AS field,
    'schema_drift_type_change_unsafe' AS anomaly_type, 'CRITICAL' AS severity,
    'Type drift on ''o_orderdate'': expected timestamp_ntz, got string ('
        || count(*) FILTER (WHERE TRY_CAST(o_orderdate AS TIMESTAMP) IS NULL)
        || ' unparseable values)' AS details
FROM ({_DATES}) GROUP BY o_orderstatus
""")
def detect_retype_any_type(spark, sf_dir):
    """The same with every type tested, here dates that arrive as text with junk among them."""
    batch = retype_to_string(table(spark, sf_dir, "orders"), "o_orderdate", ORDERS.key, corrupt=True)
    run = F.concat(F.lit("run_"), F.col("o_orderstatus"))
    found = detect(batch, ORDERS, run, AS_OF, probe="all")
    return found.select("run_id", "field", "anomaly_type", "severity", "details")


@query(detect_sql("events", EVENTS_DRIFTED, "'run_all'", f"'{AS_OF}'", ("value",)))
def detect_multi(spark, sf_dir):
    return detect(events_drifted(spark, sf_dir), EVENTS, "run_all", AS_OF)


DRILL_CASES = [
    (entity, kind, force)
    for kind, forces in (
        ("column_added", {e: (False,) for e in DRILLS}),
        ("column_removed", {e: (False, True) for e in DRILLS}),
        ("type_changed", {"transactions": (False,), "accounts": (False,), "customers": (False, True)}),
    )
    for entity in DRILLS
    for force in forces[entity]
]


def _golden_sql(entity: str, kind: str, force: bool) -> str:
    source, key, value = {
        "transactions": ("events", "event_id", "value"),
        "accounts": ("orders", "o_orderkey", "o_totalprice"),
        "customers": ("customer", "c_custkey", None),
    }[entity]
    spec = DRILLS[entity]
    bad = "0::BIGINT"
    if kind == "column_added":
        found = (spec.add[0], "schema_drift_column_added", "LOW", "drop_added_column")
    elif kind == "column_removed" and not force:
        found = (spec.remove, "schema_drift_column_removed_non_critical", "MEDIUM", "fill_null_and_warn")
    elif kind == "column_removed":
        found = (spec.remove_critical, "schema_drift_column_removed_critical", "CRITICAL", "quarantine_batch")
        bad = "count(*)"
    elif value is None:
        found = (spec.retype, "schema_drift_type_change_safe", "MEDIUM", "cast_and_warn")
    else:
        found = (spec.retype, "schema_drift_type_change_unsafe", "CRITICAL", "quarantine_affected_records")
        bad = f"count(*) FILTER (WHERE {bad_sql(corrupt_sql(value, key + '::VARCHAR'))})"
    field, anomaly, severity, action = found
    return f"""SELECT '{entity}' AS entity, '{kind}' AS drift_type, {str(force).lower()} AS force_critical,
        '{field}' AS field, '{anomaly}' AS anomaly_type, '{severity}' AS severity, '{action}' AS action,
        count(*) - {bad} AS rows_surviving, {bad} AS rows_quarantined FROM {source}"""


@query(" UNION ALL ".join(_golden_sql(*case) for case in DRILL_CASES))
def drill_outcomes(spark, sf_dir):
    """Every drill of the three entities: what is found, and where the rows end up."""
    outcomes = []
    for entity, kind, force in DRILL_CASES:
        contract = CONTRACTS[entity]
        batch = drill(BASELINES[entity](spark, sf_dir), DRILLS[entity], kind, contract.key, force).df
        assessed = assess(batch, contract, f"run_{entity}", AS_OF)
        outcomes.append(
            assessed.select(
                F.lit(kind).alias("drift_type"), F.lit(force).alias("force_critical"),
                "rows_surviving", "rows_quarantined", F.inline("anomalies"),
            ).select(
                "entity", "drift_type", "force_critical", "field", "anomaly_type", "severity",
                "action", "rows_surviving", "rows_quarantined",
            )
        )
    return reduce(DataFrame.union, outcomes)


# -- repair ------------------------------------------------------------------------


def _healed(df: DataFrame, contract):
    return heal(df, contract, detect(df, contract, "run_all", AS_OF))


@query("SELECT * FROM orders")
def heal_drop_added(spark, sf_dir):
    return _healed(mutate_add_column(spark, sf_dir), ORDERS).clean


@query("SELECT * REPLACE (NULL::VARCHAR AS props) FROM events")
def heal_fill_null(spark, sf_dir):
    return _healed(mutate_drop_noncritical(spark, sf_dir), EVENTS).clean


@query("SELECT * REPLACE (c_nationkey::VARCHAR AS c_nationkey) FROM customer")
def heal_warn_retype(spark, sf_dir):
    return _healed(mutate_retype_safe(spark, sf_dir), CUSTOMER).clean


@query("SELECT * FROM customer")
def heal_cast_retype(spark, sf_dir):
    """The same batch with the column cast back to the contract's type."""
    batch = mutate_retype_safe(spark, sf_dir)
    return heal(batch, CUSTOMER, detect(batch, CUSTOMER, "run_all", AS_OF), on_safe="cast").clean


@query("""
SELECT * EXCLUDE (value), 'full_batch:schema_drift_column_removed_critical' AS _quarantine_reason
FROM events
""")
def quarantine_batch(spark, sf_dir):
    batch = mutate_drop_critical(spark, sf_dir)
    return _healed(batch, EVENTS).quarantine.drop("_quarantine_reasons")


@query(f"""
SELECT *, 'unparseable:value' AS _quarantine_reason FROM ({EVENTS_UNSAFE}) WHERE {bad_sql("value")}
""")
def quarantine_rows(spark, sf_dir):
    return _healed(events_unsafe(spark, sf_dir), EVENTS).quarantine.drop("_quarantine_reasons")


@query(f"SELECT * FROM ({EVENTS_UNSAFE}) WHERE NOT {bad_sql('value')}")
def clean_rows(spark, sf_dir):
    return _healed(events_unsafe(spark, sf_dir), EVENTS).clean


@query(f"""
SELECT _quarantine_reason, count(*) AS n_rows
FROM (SELECT 'unparseable:value' AS _quarantine_reason FROM ({EVENTS_UNSAFE}) WHERE {bad_sql("value")})
GROUP BY 1
""")
def quarantine_reason_counts(spark, sf_dir):
    held = _healed(events_unsafe(spark, sf_dir), EVENTS).quarantine
    return held.groupBy("_quarantine_reason").agg(F.count(F.lit(1)).alias("n_rows"))


_LINES = "SELECT * REPLACE (" + ", ".join(
    f"{corrupt_sql(c, LINE_KEY, LINE_SALTS[c])} AS {c}" for c in ("l_extendedprice", "l_quantity")
) + ") FROM lineitem"


@query(" UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, 'unparseable:{c}' AS reason "
    f"FROM ({_LINES}) WHERE {bad_sql(c)}"
    for c in ("l_extendedprice", "l_quantity")
))
def quarantine_multi_reason(spark, sf_dir):
    """Two columns with junk in one batch: each held-back row once per reason."""
    held = _healed(lines_unsafe(spark, sf_dir), LINEITEM).quarantine_by_reason
    return held.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "reason")


@query(f"""
SELECT run_id, anomaly_type, field, details, action AS applied_action,
    CASE action WHEN 'quarantine_affected_records' THEN bad ELSE 0 END AS rows_affected
FROM ({anomalies_sql("events", EVENTS_DRIFTED, DAY_RUN, DAY_END, ("value",))})
""")
def action_audit(spark, sf_dir):
    assessed = assess(events_drifted(spark, sf_dir), EVENTS, day_run(), day_end())
    return actions_of(assessed).select(
        "run_id", "anomaly_type", "field", "details", "applied_action", "rows_affected"
    )
