import shutil
from datetime import datetime, timedelta

import pytest

from driftgate.streaming import close_windows, read_closed, read_late, read_open, read_timeless

DAY = datetime(2024, 1, 1)


def at(day, hour=0):
    return DAY + timedelta(days=day - 1, hours=hour)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_windows_close_once_and_late_rows_are_counted(spark, root, kind):
    schema = f"ts {kind}, k string"
    batches = [
        [(at(1, 1), "a"), (at(1, 2), "a"), (at(2, 5), None), (None, "a")],
        [(at(3, 1), "a"), (at(1, 23), "b")],  # day 1 is open: up to here the watermark is day 2, 5 - 12 hours
        [(at(1, 3), "a"), (at(2, 1), None), (at(2, 23), "z"), (at(5, 1), "a"), (None, "b")],
        [(at(5, 2), "a"), (at(4, 12), "a"), (at(2, 2), "z")],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        close_windows(stream, "ts", f"{root}/out", f"{root}/check", lateness="12 hours", by=["k"]).awaitTermination()
    out = f"{root}/out"
    closed = [(r["window_start"], r["k"], r["n_rows"]) for r in read_closed(spark, out).collect()]
    assert sorted(closed, key=str) == sorted(
        [(at(1), "a", 2), (at(1), "b", 1), (at(2), None, 2), (at(2), "z", 1), (at(3), "a", 1)], key=str
    )
    assert dict(read_closed(spark, out).dtypes)["window_start"] == kind
    late = {(r["window_start"], r["k"]): r["n_late"] for r in read_late(spark, out).collect()}
    assert late == {(at(1), "a"): 1, (at(2), "z"): 1}
    opened = {(r["window_start"], r["k"]): r["n_rows"] for r in read_open(spark, out).collect()}
    assert opened == {(at(4), "a"): 1, (at(5), "a"): 2}
    assert read_timeless(spark, out) == 2


def test_a_replayed_batch_starts_from_what_the_one_before_left(spark, root):
    def run(rows):
        if rows:
            spark.createDataFrame(rows, "ts timestamp").coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema("ts timestamp").parquet(f"{root}/in")
        close_windows(stream, "ts", f"{root}/out", f"{root}/check", lateness="1 hour").awaitTermination()

    run([(at(1),), (at(1, 5),)])
    run([(at(1, 7),), (at(3),)])
    before = sorted(read_closed(spark, f"{root}/out").collect()), sorted(read_open(spark, f"{root}/out").collect())
    shutil.rmtree(f"{root}/check/commits")  # as if the driver had been lost before the commit
    shutil.rmtree(f"{root}/out/reached/_batch_id=1")
    run([])
    after = sorted(read_closed(spark, f"{root}/out").collect()), sorted(read_open(spark, f"{root}/out").collect())
    assert after == before and [r["n_rows"] for r in after[0]] == [3]


def test_rows_without_any_time_close_nothing(spark, root):
    spark.createDataFrame([(None,)], "ts timestamp").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("ts timestamp").parquet(f"{root}/in")
    close_windows(stream, "ts", f"{root}/out", f"{root}/check").awaitTermination()
    assert read_timeless(spark, f"{root}/out") == 1
