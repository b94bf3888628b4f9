import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftgate.operators import detect, heal
from driftgate.streaming import (
    count_windows,
    gate,
    read_gate,
    read_gate_actions,
    read_gate_anomalies,
    read_gate_log,
    read_windows,
)
from tests.test_queries import QUERIES, SMALL
from workload.tables import EVENTS, events_unsafe


def landing(spark, root, df, files=3):
    path = f"{root}/landing"
    df.repartition(files).write.mode("append").parquet(path)
    return path, spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_gate_agrees_with_the_batch_split(spark, root):
    batch = events_unsafe(spark, SMALL)
    _, stream = landing(spark, root, batch)
    gate(stream, EVENTS, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    expected = heal(batch, EVENTS, detect(batch, EVENTS, "r", "now"))
    for disposition, rows in (("clean", expected.clean), ("quarantine", expected.quarantine)):
        ours = read_gate(spark, f"{root}/out", disposition).select("event_id", "value")
        assert sorted(ours.collect()) == sorted(rows.select("event_id", "value").collect())
    log = read_gate_log(spark, f"{root}/out").collect()
    assert len(log) == 3 and sum(r["rows_total"] for r in log) == 1000
    assert sum(r["rows_quarantined"] for r in log) == expected.quarantine.count()


def test_replayed_batches_overwrite_themselves(spark, root):
    _, stream = landing(spark, root, events_unsafe(spark, SMALL), files=2)
    for attempt in range(2):
        # A lost checkpoint makes the second attempt replay every batch.
        gate(stream, EVENTS, f"{root}/out", f"{root}/checkpoint{attempt}").awaitTermination()
    assert spark.read.parquet(f"{root}/out/batches").count() == 1000


def test_gate_holds_back_a_stream_without_a_critical_column(spark, root):
    _, stream = landing(spark, root, events_unsafe(spark, SMALL).drop("value"))
    gate(stream, EVENTS, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    assert read_gate(spark, f"{root}/out", "quarantine").count() == 1000
    totals = read_gate_log(spark, f"{root}/out").agg(F.sum("rows_quarantined")).first()
    assert totals[0] == 1000


def test_gate_holds_back_rows_of_files_that_lost_a_critical_column(spark, root):
    whole = events_unsafe(spark, SMALL)
    _, stream = landing(spark, root, whole, 1)
    landing(spark, root, whole.drop("value").withColumn("tier", F.lit("GOLD")), 1)
    gate(stream, EVENTS, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    held = read_gate(spark, f"{root}/out", "quarantine")
    assert held.filter("_quarantine_reason = 'missing:value'").count() == 1000
    assert read_gate(spark, f"{root}/out", "clean").filter("value IS NULL").count() == 0
    log = {len(r["rows_missing"]): r.asDict() for r in read_gate_log(spark, f"{root}/out").collect()}
    assert log[1]["rows_missing"] == {"value": 1000} and log[1]["rows_quarantined"] == 1000
    assert log[0]["rows_surviving"] + log[0]["rows_quarantined"] == 1000
    found = read_gate_anomalies(spark, f"{root}/out").select("run_id", "field", "severity").collect()
    assert len(found) == 2 and {r["field"] for r in found} == {"value"}
    moved = {r["run_id"]: r["rows_affected"] for r in read_gate_actions(spark, f"{root}/out").collect()}
    assert sorted(moved.values()) == [0, log[0]["rows_quarantined"]]


def at(*when):
    return dt.datetime(2024, 1, *when)


def test_windows_and_late_rows(spark, root):
    def land(rows):
        df = spark.createDataFrame([(t,) for t in rows], "ts timestamp_ntz")
        return landing(spark, root, df, 1)[1]

    def drain():
        started = count_windows(stream, "ts", f"{root}/out", f"{root}/checkpoint", "1 hour", "30 minutes")
        started.awaitTermination()
        return started

    stream = land([at(1, 0, 10), at(1, 0, 50), at(1, 1, 5)])
    drain()
    land([at(1, 0, 55), at(1, 3, 0)])
    drain()
    land([at(1, 0, 59), at(1, 3, 30)])
    late = drain()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in late.recentProgress for op in p["stateOperators"])
    assert dropped == 1
    counts = {r["window_start"].hour: r["n_rows"] for r in read_windows(spark, f"{root}/out").collect()}
    assert counts == {0: 3, 1: 1, 3: 2}


def test_windows_by_group(spark, root):
    df = spark.createDataFrame([(at(1, 1), "a"), (at(1, 2), "b"), (at(2, 1), "a")], "ts timestamp_ntz, g string")
    _, stream = landing(spark, root, df, 2)
    count_windows(stream, "ts", f"{root}/out", f"{root}/checkpoint", by=["g"]).awaitTermination()
    rows = {(r["window_start"].day, r["g"]): r["n_rows"] for r in read_windows(spark, f"{root}/out").collect()}
    assert rows == {(1, "a"): 1, (1, "b"): 1, (2, "a"): 1}


def test_queries_take_a_table_of_many_files(spark, root):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.repartition(3).write.parquet(f"{root}/events.parquet")
    assert QUERIES["stream_gate_log"](spark, root).first()["rows_total"] == 1000
    assert QUERIES["stream_volume"](spark, root).agg(F.sum("n_rows")).first()[0] == 1000


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_plain_timestamps_are_counted_by_their_own_clock(spark, root, zone):
    df = spark.createDataFrame([(at(1, 0, 1),), (at(1, 23, 59),), (at(2, 0, 0),)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        _, stream = landing(spark, root, df, 1)
        count_windows(stream, "ts", f"{root}/out", f"{root}/checkpoint").awaitTermination()
        rows = {(r["window_start"], r["window_end"]): r["n_rows"] for r in read_windows(spark, f"{root}/out").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows == {(at(1), at(2)): 2, (at(2), at(3)): 1}


def test_zoned_timestamps_stay_zoned(spark, root):
    df = spark.createDataFrame([(at(1, 5),)], "ts timestamp")
    _, stream = landing(spark, root, df, 1)
    count_windows(stream, "ts", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    assert dict(read_windows(spark, f"{root}/out").dtypes)["window_start"] == "timestamp"


def test_append_mode_writes_closed_windows_once(spark, root):
    rows = [(at(1, 1),), (at(1, 2),), (at(2, 1),), (at(3, 1),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    for i in range(2):
        part = df.filter(F.dayofmonth("ts") <= 2 if i == 0 else F.dayofmonth("ts") > 2)
        _, stream = landing(spark, root, part, 1)
        started = count_windows(stream, "ts", f"{root}/out", f"{root}/checkpoint", output_mode="append")
        started.awaitTermination()
    written = spark.read.parquet(f"{root}/out")
    assert {(r["window_start"].day, r["n_rows"]) for r in written.collect()} == {(1, 2), (2, 1)}
    assert written.count() == 2
