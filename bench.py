"""Time the headline operators on $BENCH_SF_DIR and print one JSON line.

Each figure is the median of warm runs. Batches are landed as several files first,
untimed, as a pipeline would find them. ``stepwise`` holds the same work done as one Spark
job per question (count each column, write each half, count again), for comparison.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.operators import (
    detect,
    drop_column,
    heal,
    key_duplicates,
    null_profile,
    orphan_summary,
    retype_to_string,
    volume_by_day,
)
from driftgate.plans import run_batch
from driftgate.sources import RunStore, build_session, read_table, workspace
from driftgate.streaming import gate
from workload.tables import EVENTS, LINE_SALTS, LINEITEM, lines_unsafe, table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
WARM_RUNS = 5
FOUR = tuple(LINE_SALTS)
ONE = ("l_extendedprice",)
AS_OF = "2024-01-31 12:00:00"


def landed(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = workspace(spark, "bench")
    df.repartition(CPUS).write.parquet(path)
    return read_table(spark, path)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_time(work: Callable[[], None]) -> float:
    work()
    times = []
    for _ in range(WARM_RUNS):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def split(store: RunStore, batch: DataFrame, contract) -> None:
    """Detection and the split write of one batch, in one pass."""
    run_batch(store, batch, contract, "bench", datetime(2024, 1, 31, 12))


def stepwise_split(spark: SparkSession, batch: DataFrame, columns) -> None:
    """The same outcome with a separate job for each count and each write."""
    root = workspace(spark, "stepwise")
    rest = batch
    for name in columns:
        bad = F.col(name).isNotNull() & F.col(name).try_cast("double").isNull()
        batch.filter(bad).count()
        held = rest.filter(bad)
        held.count()
        held.write.parquet(f"{root}/held_{name}")
        rest = rest.filter(~bad)
    rest.write.parquet(f"{root}/clean")
    rest.count()


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    one = landed(spark, lines_unsafe(spark, SF_DIR, ONE))
    four = landed(spark, lines_unsafe(spark, SF_DIR, FOUR))
    lost = landed(spark, drop_column(table(spark, SF_DIR, "lineitem"), "l_extendedprice"))
    events = landed(spark, retype_to_string(table(spark, SF_DIR, "events"), "value", EVENTS.key, True))
    lines = landed(spark, table(spark, SF_DIR, "lineitem"))
    orders = landed(spark, table(spark, SF_DIR, "orders"))
    store = RunStore(spark, workspace(spark, "bench-runs"))

    shipped = F.date_format("l_shipdate", "yyyyMMdd")
    stream = spark.readStream.schema(events.schema).parquet(events.inputFiles()[0].rsplit("/", 1)[0])

    def stream_all():
        root = workspace(spark, "bench-gate")
        gate(stream, EVENTS, f"{root}/out", f"{root}/checkpoint").awaitTermination()

    def quarantine_only():
        found = detect(one, LINEITEM, "bench", AS_OF)
        drain(heal(one, LINEITEM, found).quarantine)

    queries = {
        "detect_one_column": lambda: detect(one, LINEITEM, "bench", AS_OF).collect(),
        "detect_four_columns": lambda: detect(four, LINEITEM, "bench", AS_OF).collect(),
        "quarantine_rows": quarantine_only,
        "run_one_column": lambda: split(store, one, LINEITEM),
        "run_four_columns": lambda: split(store, four, LINEITEM),
        "run_full_batch": lambda: split(store, lost, LINEITEM),
        "run_events": lambda: split(store, events, EVENTS),
        "detect_many_runs": lambda: drain(detect(four, LINEITEM, shipped, AS_OF)),
        "null_profile": lambda: null_profile(lines, LINEITEM).collect(),
        "volume_anomaly": lambda: volume_by_day(events, "ts").collect(),
        "fk_orphans": lambda: orphan_summary(lines, "l_orderkey", orders, "o_orderkey").collect(),
        "stream_gate": stream_all,
        "key_duplicates": lambda: drain(key_duplicates(lines, LINEITEM.key)),
    }
    stepwise = {
        "run_one_column": lambda: stepwise_split(spark, one, ONE),
        "run_four_columns": lambda: stepwise_split(spark, four, FOUR),
    }
    for work in queries.values():  # warm the JVM for all before timing any
        work()
    times = {name: median_time(work) for name, work in queries.items()}
    compared = {name: median_time(work) for name, work in stepwise.items()}
    print(json.dumps({
        "metric": "sum of median warm times",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "stepwise": compared,
        "rows": {"lineitem": lines.count(), "events": events.count()},
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
