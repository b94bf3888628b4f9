"""Queries of the quality, volume and key checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.functions import hash_bucket
from driftgate.operators import (
    KeyLedger,
    amount_bands,
    daily_profiles,
    domain_share,
    domain_violations,
    hour_profile,
    key_duplicates,
    null_profile,
    null_spikes,
    orphan_keys,
    orphan_summary,
    profile_range as profile_of_range,
    range_violations,
    read_profiles,
    store_profiles,
    volume_by_day,
)
from driftgate.settings import BALANCE_BOUNDS, DOMAINS, PROFILES, profile
from driftgate.sources import workspace
from driftgate.streaming import close_windows, judge_closed_days
from workload.entities import accounts, transactions
from workload.registry import query
from workload.tables import EVENT_KEY, EVENTS, bucket_sql, table

# -- nulls -------------------------------------------------------------------------


def _gappy(spark, sf_dir) -> DataFrame:
    """Events with nulls, blanks and a few rows without content, chosen by key."""
    events = table(spark, sf_dir, "events")
    empty = hash_bucket("event_id", 10) < 30

    def lost(name, salt, share):
        return F.when(~(empty | (hash_bucket("event_id", salt) < share)), F.col(name)).alias(name)

    kind = F.when(hash_bucket("event_id", 9) < 400, F.lit(" ")).otherwise(F.col("event_type"))
    return events.select(
        "event_id",
        F.when(~empty, F.col("ts")).alias("ts"),
        F.when(~empty, F.col("user_id")).alias("user_id"),
        F.when(~empty, kind).alias("event_type"),
        lost("value", 8, 700),
        lost("props", 7, 1500),
    )


_EMPTY = f"{bucket_sql(EVENT_KEY, 10)} < 30"
_GAPPY = f"""
SELECT event_id, CASE WHEN NOT {_EMPTY} THEN ts END AS ts,
    CASE WHEN NOT {_EMPTY} THEN user_id END AS user_id,
    CASE WHEN NOT {_EMPTY} THEN
        CASE WHEN {bucket_sql(EVENT_KEY, 9)} < 400 THEN ' ' ELSE event_type END END AS event_type,
    CASE WHEN NOT ({_EMPTY} OR {bucket_sql(EVENT_KEY, 8)} < 700) THEN value END AS value,
    CASE WHEN NOT ({_EMPTY} OR {bucket_sql(EVENT_KEY, 7)} < 1500) THEN props END AS props
FROM events
"""


def _profile_sql(limits) -> str:
    checks = []
    for f in EVENTS.schema.fields:
        limit = limits.critical_null_rate if f.name in EVENTS.critical else limits.null_rate
        checks.append((f.name, "null", f"{f.name} IS NULL", limit))
        if f.dataType.simpleString() == "string":
            checks.append((f.name, "empty", f"trim({f.name}) = ''", limits.empty_rate))
    nothing = " AND ".join(f"{f.name} IS NULL" for f in EVENTS.schema.fields if f.name != "event_id")
    checks.append(("*", "all_null", nothing, limits.all_null_rate))
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS field, '{metric}' AS metric, count(*) AS n_rows,
            count(*) FILTER (WHERE {test}) AS n_hits,
            count(*) FILTER (WHERE {test})::DOUBLE / count(*) AS rate,
            {float(limit)}::DOUBLE AS max_rate,
            count(*) FILTER (WHERE {test})::DOUBLE / count(*) > {float(limit)}::DOUBLE AS flagged
            FROM ({_GAPPY})"""
        for name, metric, test, limit in checks
    )


@query(_profile_sql(profile("moderate")), name="null_profile")
def null_rates(spark, sf_dir):
    return null_profile(_gappy(spark, sf_dir), EVENTS)


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS profile, * FROM ({_profile_sql(limits)})"
    for name, limits in PROFILES.items()
),
    name="null_profile_by_limits",
)
def null_rates_by_profile(spark, sf_dir):
    """The same batch judged by each named set of limits."""
    return null_profile(_gappy(spark, sf_dir), EVENTS, PROFILES)


_SPIKE_DAYS = ("2024-01-08", "2024-01-17")


@query(f"""
SELECT day, 'value' AS field, n_rows, n_nulls, n_nulls::DOUBLE / n_rows AS rate,
    n_nulls::DOUBLE / n_rows >= 0.25 AS spike
FROM (SELECT ts::DATE AS day, count(*) AS n_rows, count(*) FILTER (WHERE {bucket_sql(EVENT_KEY, 11)}
          < CASE WHEN ts::DATE IN ('2024-01-08', '2024-01-17') THEN 4000 ELSE 500 END) AS n_nulls
      FROM events GROUP BY 1)
UNION ALL
SELECT day, field, count(*), count(*) FILTER (WHERE gone), count(*) FILTER (WHERE gone)::DOUBLE / count(*),
    count(*) FILTER (WHERE gone)::DOUBLE / count(*) >= 0.25
FROM (SELECT ts::DATE AS day, unnest(['event_id', 'user_id', 'event_type', 'props']) AS field,
          unnest([event_id IS NULL, user_id IS NULL, event_type IS NULL, props IS NULL]) AS gone FROM events)
GROUP BY 1, 2
""",
    name="null_spike_daily",
)
def null_spikes_daily(spark, sf_dir):
    share = F.when(F.to_date("ts").cast("string").isin(*_SPIKE_DAYS), 4000).otherwise(500)
    value = F.when(hash_bucket("event_id", 11) >= share, F.col("value"))
    return null_spikes(table(spark, sf_dir, "events").withColumn("value", value), "ts")


# -- volume -------------------------------------------------------------------------

# Copies of each event by day: one day tripled, one thinned, one gone, then a long decline. One type stops early.
_STOPPED = ("purchase", "2024-01-25")
_COPIES = {"2024-01-12": 3, "2024-01-18": 0}
_THINNED = {"2024-01-15": 7000, "2024-01-21": 2000, "2024-01-22": 4000, "2024-01-23": 5500,
            "2024-01-24": 6700, "2024-01-25": 7600, "2024-01-26": 8300}


def _uneven(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts").cast("string")
    copies = F.lit(1)
    for date, n in _COPIES.items():
        copies = F.when(day == date, F.lit(n)).otherwise(copies)
    for date, share in _THINNED.items():
        kept = F.when(hash_bucket("event_id", 12) >= share, 1).otherwise(0)
        copies = F.when(day == date, kept).otherwise(copies)
    kind, stop = _STOPPED
    copies = F.when((F.col("event_type") == kind) & (day >= stop), 0).otherwise(copies)
    return events.select("event_id", "ts", "event_type", F.explode(F.array_repeat(F.lit(1), copies)))


_KEPT = (
    f"CASE WHEN event_type = '{_STOPPED[0]}' AND ts::DATE::VARCHAR >= '{_STOPPED[1]}' THEN 0 ELSE "
    "CASE ts::DATE::VARCHAR "
    + "".join(f"WHEN '{d}' THEN {n} " for d, n in _COPIES.items())
    + "".join(
        f"WHEN '{d}' THEN CASE WHEN {bucket_sql(EVENT_KEY, 12)} >= {s} THEN 1 ELSE 0 END "
        for d, s in _THINNED.items()
    )
    + "ELSE 1 END END"
)


def _volume_sql(by: str = "") -> str:
    key = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    on = f"USING ({key}day)"
    return f"""
    WITH daily AS (SELECT {key}ts::DATE AS day, sum({_KEPT})::BIGINT AS n FROM events GROUP BY ALL),
    span AS (SELECT min(day) AS lo, max(day) AS hi FROM daily WHERE n > 0),
    spine AS (SELECT {key}unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS day
              FROM span{f", (SELECT DISTINCT {by} FROM daily WHERE n > 0)" if by else ""}),
    filled AS (SELECT {key}day, coalesce(n, 0) AS n FROM spine LEFT JOIN daily {on}),
    step AS (SELECT *, CASE WHEN n <= 0.9::DOUBLE * lag(n) OVER ({part}ORDER BY day)
                       THEN 1 ELSE 0 END AS fell,
        avg(n) OVER ({part}ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mean,
        count(n) OVER ({part}ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS seen FROM filled),
    run AS (SELECT *, sum(fell) OVER ({part}ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS falls
            FROM step)
    SELECT {key}day, n AS n_rows, mean AS trailing_mean,
        CASE WHEN n = 0 THEN 'zero' WHEN n >= 2.0::DOUBLE * mean THEN 'spike'
             WHEN n <= 0.5::DOUBLE * mean THEN 'drop' END AS flag,
        falls = 5 AS declining
    FROM run WHERE seen = 7"""


@query(_volume_sql(), name="volume_anomaly")
def volume_daily(spark, sf_dir):
    return volume_by_day(_uneven(spark, sf_dir), "ts")


def _closed_days(spark, sf_dir, by) -> str:
    """The same events as a stream, in two parts by time."""
    root, events = workspace(spark, "closed-days"), _uneven(spark, sf_dir)
    landing, early = f"{root}/landing", F.dayofmonth("ts") <= 15
    for part in (events.filter(early), events.filter(~early)):
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.schema).parquet(landing)
        close_windows(stream, "ts", f"{root}/out", f"{root}/checkpoint", by=by).awaitTermination()
    return f"{root}/out"


@query(_volume_sql())
def stream_volume_anomaly(spark, sf_dir):
    """Daily volume of a stream, flagged from the windows that it closed and the last open one."""
    return judge_closed_days(spark, _closed_days(spark, sf_dir, ()), final=False)


@query(f"SELECT * FROM ({_volume_sql('event_type')}) WHERE day < (SELECT (max(ts) - INTERVAL 1 HOUR)::DATE FROM events)")
def stream_volume_anomaly_by_type(spark, sf_dir):
    """The same by event type, of closed windows only."""
    return judge_closed_days(spark, _closed_days(spark, sf_dir, ["event_type"]), by=["event_type"])


@query(_volume_sql("event_type"), name="volume_anomaly_by_type")
def volume_daily_by_type(spark, sf_dir):
    return volume_by_day(_uneven(spark, sf_dir), "ts", by=["event_type"])


# -- domains, ranges, profiles --------------------------------------------------------


@query("""
SELECT o_orderstatus AS value, count(*) AS n_rows FROM orders
WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1
""")
def domain_check(spark, sf_dir):
    return domain_violations(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"])


@query("""
WITH typed AS (SELECT CASE event_type WHEN 'view' THEN 'DEBIT' WHEN 'click' THEN 'CREDIT'
                           WHEN 'purchase' THEN 'PAYMENT' ELSE 'TRANSFER' END AS value FROM events)
SELECT d.value, count(t.value) AS n_rows,
    count(t.value)::DOUBLE / (SELECT count(*) FROM typed) AS share, d.w::DOUBLE / 100 AS expected_share
FROM (VALUES ('DEBIT', 35), ('CREDIT', 30), ('TRANSFER', 20), ('PAYMENT', 15), ('(other)', 0)) d(value, w)
LEFT JOIN typed t ON t.value = d.value GROUP BY d.value, d.w
UNION ALL SELECT NULL, count(*) FILTER (WHERE value IS NULL), count(*) FILTER (WHERE value IS NULL)::DOUBLE / count(*), 0
FROM typed
""",
    name="domain_share",
)
def domain_shares(spark, sf_dir):
    weights = DOMAINS["transaction_type"]
    return domain_share(transactions(spark, sf_dir), "transaction_type", weights)


@query("""
SELECT o_orderkey::VARCHAR AS account_id, a.category AS account_type, o_totalprice AS balance, low, high,
    CASE WHEN b.category IS NULL THEN 'unknown_category' ELSE 'out_of_range' END AS reason
FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'SAVINGS' WHEN 'O' THEN 'CHECKING' ELSE 'LOAN' END
             AS category FROM orders) a
LEFT JOIN (VALUES ('SAVINGS', 100.0::DOUBLE, 500000.0::DOUBLE), ('CHECKING', 50.0, 100000.0),
             ('CREDIT', -50000.0, 0.0)) b(category, low, high)
    ON a.category = b.category
WHERE b.category IS NULL OR NOT o_totalprice BETWEEN low AND high
""")
def range_by_category(spark, sf_dir):
    """Balances outside the bounds of their type, loans without any bounds."""
    bounds = {kind: b for kind, b in BALANCE_BOUNDS.items() if kind != "LOAN"}
    outside = range_violations(accounts(spark, sf_dir), "account_type", "balance", bounds)
    return outside.select("account_id", "account_type", "balance", "low", "high", "reason")


@query("""
SELECT band, count(*) AS n_rows, count(*)::DOUBLE / (SELECT count(*) FROM orders) AS share,
    CASE band WHEN 0 THEN 0.6 WHEN 1 THEN 0.25 WHEN 2 THEN 0.12 WHEN 3 THEN 0.03 ELSE 0 END::DOUBLE
        AS expected_share
FROM (SELECT CASE WHEN o_totalprice < 100 THEN 0 WHEN o_totalprice < 1000 THEN 1
                  WHEN o_totalprice < 10000 THEN 2 WHEN o_totalprice < 100000 THEN 3 ELSE 4 END AS band
      FROM orders)
GROUP BY band
""",
    name="amount_bands",
)
def amount_profile(spark, sf_dir):
    return amount_bands(table(spark, sf_dir, "orders"), "o_totalprice")


@query("""
SELECT hour(ts)::INTEGER AS hour, count(*) AS n_rows,
    count(*)::DOUBLE / (SELECT count(*) FROM events) AS share,
    [1, 1, 1, 1, 1, 2, 4, 6, 8, 9, 10, 10, 9, 8, 7, 6, 5, 7, 8, 9, 7, 5, 3, 2][hour(ts) + 1]::DOUBLE
        / 130 AS expected_share
FROM events GROUP BY hour(ts)
""",
    name="hour_profile",
)
def hour_profile_daily(spark, sf_dir):
    return hour_profile(table(spark, sf_dir, "events"), "ts")


# -- keys ----------------------------------------------------------------------------

_PARENTS = f"SELECT c_custkey FROM customer WHERE {bucket_sql('c_custkey::VARCHAR', 3)} >= 1000"


def _thinned_customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").filter(hash_bucket("c_custkey", 3) >= 1000)


@query(f"""
SELECT user_id AS key, count(*) AS n_rows FROM events
WHERE user_id NOT IN ({_PARENTS}) GROUP BY 1
""")
def fk_orphans(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return orphan_keys(events, "user_id", _thinned_customers(spark, sf_dir), "c_custkey")


@query(f"""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE orphan) AS n_orphan_rows,
    count(DISTINCT o_custkey) FILTER (WHERE orphan) AS n_orphan_keys
FROM (SELECT o_custkey, o_custkey NOT IN ({_PARENTS}) AS orphan FROM orders)
""")
def fk_orphan_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orphan_summary(orders, "o_custkey", _thinned_customers(spark, sf_dir), "c_custkey")


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""",
    name="key_duplicates",
)
def duplicate_keys(spark, sf_dir):
    return key_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- keys across runs ------------------------------------------------------------------

_PARTS = {"run_first": ("2024-01-01", "2024-01-11"), "run_second": ("2024-01-11", "2024-01-21")}
_LAST = "2024-01-21"


@query(f"""
WITH gappy AS ({_GAPPY}),
batch AS (SELECT user_id, event_type, count(*) AS n_rows FROM gappy WHERE ts >= '{_LAST}' GROUP BY 1, 2),
earlier AS (
    SELECT user_id, event_type, count(*) AS n_earlier, count(DISTINCT run) AS n_runs, min(run) AS first_run
    FROM ({" UNION ALL ".join(
        f"SELECT user_id, event_type, '{run}' AS run FROM gappy WHERE ts >= '{low}' AND ts < '{high}'"
        for run, (low, high) in _PARTS.items())})
    GROUP BY 1, 2)
SELECT b.user_id, b.event_type, n_rows, coalesce(n_earlier, 0)::BIGINT AS n_earlier,
    coalesce(n_runs, 0)::BIGINT AS n_runs, first_run
FROM batch b LEFT JOIN earlier e
    ON b.user_id IS NOT DISTINCT FROM e.user_id AND b.event_type IS NOT DISTINCT FROM e.event_type
WHERE n_rows > 1 OR n_earlier IS NOT NULL
""")
def key_duplicates_across_runs(spark, sf_dir) -> DataFrame:
    """The last days' keys that occur twice among them or in an earlier run, against stored keys; one run recorded twice."""
    events = _gappy(spark, sf_dir)
    ledger = KeyLedger(spark, workspace(spark, "keys"), ["user_id", "event_type"], buckets=16)
    for run, (low, high) in _PARTS.items():
        ledger.record(events.filter((F.col("ts") >= low) & (F.col("ts") < high)), run)
    last = events.filter(F.col("ts") >= _LAST)
    ledger.record(last.limit(0), "run_last")
    ledger.record(last, "run_last")
    return ledger.duplicates(last, "run_last")


# -- profiles of ranges ----------------------------------------------------------------

_SPAN = (date(2024, 1, 5), date(2024, 1, 20))
_PROFILED = ("value", "user_id", "event_type")


@query(f"""
SELECT field, count(DISTINCT day) AS n_days, count(*) AS n_rows, count(*) - count(filled) AS n_nulls,
    min(number) AS low, max(number) AS high, true AS distinct_within, true AS median_within
FROM (
    SELECT CAST(ts AS DATE) AS day, unnest([
        {{'field': 'value', 'filled': CAST(value AS VARCHAR), 'number': CAST(value AS DOUBLE)}},
        {{'field': 'user_id', 'filled': CAST(user_id AS VARCHAR), 'number': CAST(user_id AS DOUBLE)}},
        {{'field': 'event_type', 'filled': event_type, 'number': NULL}}], recursive := true)
    FROM events)
WHERE day BETWEEN DATE '{_SPAN[0]}' AND DATE '{_SPAN[1]}'
GROUP BY field
""")
def profile_range(spark, sf_dir) -> DataFrame:
    """Events of some days, merged from stored daily sketches and held against the events themselves."""
    events = table(spark, sf_dir, "events")
    path = workspace(spark, "profiles")
    store_profiles(daily_profiles(events, "ts", _PROFILED), path)
    found = profile_of_range(read_profiles(spark, path), *_SPAN)
    inside = events.filter(F.to_date("ts").between(*map(F.lit, _SPAN)))
    each = inside.select(
        F.inline(F.array(*[
            F.struct(
                F.lit(c).alias("field"),
                F.col(c).cast("string").alias("filled"),
                (F.col(c).cast("double") if c != "event_type" else F.lit(None).cast("double")).alias("number"),
            )
            for c in _PROFILED
        ]))
    )
    # Three rows of estimates against every event: the share of values up to the estimated median, and the distinct ones.
    exact = each.join(F.broadcast(found.select("field", "p50")), "field").groupBy("field").agg(
        F.count_distinct("filled").alias("distinct"),
        F.avg((F.col("number") < F.col("p50")).cast("double")).alias("below"),
        F.avg((F.col("number") <= F.col("p50")).cast("double")).alias("up_to"),
    )
    near = F.abs(F.col("n_distinct") - F.col("distinct")) <= 0.05 * F.col("distinct") + 1
    median = F.col("below").isNull() | ((F.col("below") <= 0.52) & (F.col("up_to") >= 0.48))
    return found.join(exact, "field").select(
        "field", "n_days", "n_rows", "n_nulls", "low", "high",
        near.alias("distinct_within"), median.alias("median_within"),
    )
