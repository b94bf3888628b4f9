"""The supplied tables as guarded datasets: contracts, drills and drifted batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.operators import add_column, drop_column, retype_to_string
from driftgate.settings import Drill
from driftgate.sources import Contract, read_table

EVENTS = Contract.of(
    "events",
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string?",
    critical=("event_id", "user_id", "event_type", "value", "ts"),
    key=("event_id",),
)
ORDERS = Contract.of(
    "orders",
    """o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,
    o_orderdate timestamp_ntz, o_orderpriority string?""",
    critical=("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"),
    key=("o_orderkey",),
)
CUSTOMER = Contract.of(
    "customer",
    "c_custkey long, c_name string?, c_nationkey integer, c_acctbal double, c_mktsegment string",
    critical=("c_custkey", "c_acctbal", "c_mktsegment"),
    key=("c_custkey",),
)
LINEITEM = Contract.of(
    "lineitem",
    """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber integer, l_quantity double,
    l_extendedprice double, l_discount double, l_tax double, l_returnflag string,
    l_linestatus string?, l_shipdate timestamp_ntz""",
    critical=("l_orderkey", "l_extendedprice"),
    key=("l_orderkey", "l_linenumber"),
)
TABLE_CONTRACTS = {c.entity: c for c in (EVENTS, ORDERS, CUSTOMER, LINEITEM)}

TABLE_DRILLS = {
    "events": Drill(("loyalty_tier", "string", "GOLD"), "props", "value", "value", True),
    "orders": Drill(
        ("credit_score", "int", 750), "o_orderpriority", "o_totalprice", "o_totalprice", True
    ),
    "customer": Drill(
        ("preferred_language", "string", "en"), "c_name", "c_acctbal", "c_nationkey", False
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


# -- drifted batches, each with its SQL ------------------------------------


def bucket_sql(key: str, salt: int) -> str:
    return f"(('0x' || substr(md5({key} || ':{salt}'), 1, 8))::BIGINT % 10000)"


def corrupt_sql(column: str, key: str, salt: int = 42) -> str:
    return (
        f"CASE WHEN {bucket_sql(key, salt)} < 3000 THEN 'N/A' "
        f"WHEN {bucket_sql(key, salt + 1)} < 2000 THEN 'ERROR' ELSE {column}::VARCHAR END"
    )


def bad_sql(column: str) -> str:
    return f"({column} IS NOT NULL AND TRY_CAST({column} AS DOUBLE) IS NULL)"


EVENT_KEY = "event_id::VARCHAR"
LINE_KEY = "l_orderkey::VARCHAR || '|' || l_linenumber::VARCHAR"


def events_unsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retype_to_string(table(spark, sf_dir, "events"), "value", EVENTS.key, corrupt=True)


EVENTS_UNSAFE = f"SELECT * REPLACE ({corrupt_sql('value', EVENT_KEY)} AS value) FROM events"


def events_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column added, one removed, one holding junk."""
    return drop_column(
        add_column(events_unsafe(spark, sf_dir), "loyalty_tier", "string", "GOLD"), "props"
    )


EVENTS_DRIFTED = (
    f"SELECT * EXCLUDE (props) REPLACE ({corrupt_sql('value', EVENT_KEY)} AS value), "
    "'GOLD' AS loyalty_tier FROM events"
)

# Columns of lineitem that get junk, each with its own salt.
LINE_SALTS = {"l_discount": 44, "l_extendedprice": 46, "l_quantity": 48, "l_tax": 50}


def lines_unsafe(spark: SparkSession, sf_dir: str, columns=("l_extendedprice", "l_quantity")):
    df = table(spark, sf_dir, "lineitem")
    for name in columns:
        df = retype_to_string(df, name, LINEITEM.key, corrupt=True, salt=LINE_SALTS[name])
    return df


def day_run(ts: str = "ts"):
    return F.concat(F.lit("run_"), F.date_format(ts, "yyyyMMdd"))


def day_end(ts: str = "ts"):
    return F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit(" 23:59:59"))


DAY_RUN = "'run_' || strftime(ts, '%Y%m%d')"
DAY_END = "strftime(ts, '%Y-%m-%d') || ' 23:59:59'"
MONTH_RUN = "'run_' || strftime(o_orderdate, '%Y%m')"
MONTH_END = "strftime(o_orderdate, '%Y-%m') || '-28 23:59:59'"
NATION_RUN = "'run_nation_' || c_nationkey::VARCHAR"
NATION_END = "'2024-01-15 00:00:00'"


def month_run():
    return F.concat(F.lit("run_"), F.date_format("o_orderdate", "yyyyMM"))


def month_end():
    return F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-28 23:59:59"))


def nation_run():
    return F.concat(F.lit("run_nation_"), F.col("c_nationkey").cast("string"))


# -- SQL of detection --------------------------------------------------------

TYPE_SQL = """CASE column_type WHEN 'BIGINT' THEN 'long' WHEN 'INTEGER' THEN 'integer'
    WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
    ELSE lower(column_type) END"""


def anomalies_sql(
    base: str, batch: str, run: str, as_of: str, tested: tuple[str, ...] = ()
) -> str:
    """Anomalies and counts by run, from the DESCRIBEd schemas of a table and a batch of it."""
    contract = TABLE_CONTRACTS[base]
    critical = ", ".join(f"'{c}'" for c in sorted(contract.critical))
    counts = "".join(f", count(*) FILTER (WHERE {bad_sql(c)}) AS bad_{c}" for c in tested)
    any_bad = " OR ".join(bad_sql(c) for c in tested) or "false"
    bad = "CASE field " + "".join(f"WHEN '{c}' THEN bad_{c} " for c in tested) + "ELSE 0 END"
    bad = bad if tested else "0"
    return f"""
    SELECT run_id, detected_at, n_rows, n_bad, '{base}' AS entity, field, bad,
        CASE WHEN wanted IS NULL THEN 'schema_drift_column_added'
             WHEN got IS NULL AND field IN ({critical}) THEN 'schema_drift_column_removed_critical'
             WHEN got IS NULL THEN 'schema_drift_column_removed_non_critical'
             WHEN bad > 0 THEN 'schema_drift_type_change_unsafe'
             ELSE 'schema_drift_type_change_safe' END AS anomaly_type,
        CASE WHEN wanted IS NULL THEN 'LOW'
             WHEN got IS NULL AND field IN ({critical}) THEN 'CRITICAL'
             WHEN got IS NOT NULL AND bad > 0 THEN 'CRITICAL'
             ELSE 'MEDIUM' END AS severity,
        CASE WHEN wanted IS NULL THEN 'drop_added_column'
             WHEN got IS NULL AND field IN ({critical}) THEN 'quarantine_batch'
             WHEN got IS NULL THEN 'fill_null_and_warn'
             WHEN bad > 0 THEN 'quarantine_affected_records'
             ELSE 'cast_and_warn' END AS action,
        CASE WHEN wanted IS NULL
                 THEN 'Unexpected new column ''' || field || ''' (' || got || ').'
             WHEN got IS NULL THEN 'Expected column ''' || field || ''' missing from source.'
             ELSE 'Type drift on ''' || field || ''': expected ' || wanted || ', got ' || got
                  || CASE WHEN bad > 0 THEN ' (' || bad || ' unparseable values)' ELSE '' END
             END AS details
    FROM (
        SELECT r.*, d.*, {bad} AS bad
        FROM (SELECT {run} AS run_id, {as_of} AS detected_at, count(*) AS n_rows,
                     count(*) FILTER (WHERE {any_bad}) AS n_bad {counts}
              FROM ({batch}) GROUP BY 1, 2) r
        CROSS JOIN (
            SELECT coalesce(e.column_name, a.column_name) AS field, e.t AS wanted, a.t AS got
            FROM (SELECT column_name, {TYPE_SQL} AS t FROM (DESCRIBE SELECT * FROM {base})) e
            FULL JOIN (SELECT column_name, {TYPE_SQL} AS t FROM (DESCRIBE {batch})) a
                ON e.column_name = a.column_name
            WHERE e.t IS DISTINCT FROM a.t) d)
    """


def detect_sql(*args, **kwargs) -> str:
    """The anomaly log of the runs."""
    return f"""
    SELECT sha256(run_id || '|' || entity || '|' || anomaly_type || '|' || field) AS anomaly_id,
        run_id, anomaly_type, severity, entity, field, detected_at, details, action
    FROM ({anomalies_sql(*args, **kwargs)})"""
