"""Profiles of ranges of days, merged from stored daily sketches."""

from datetime import date

import numpy as np
from pyspark.sql import functions as F

from driftgate.operators import daily_profiles, profile_range, read_profiles, store_profiles
from driftgate.operators.ranges import QUANTILES, RANK_ERROR


def stored(spark, tmp_path, df):
    path = str(tmp_path / "profiles")
    store_profiles(daily_profiles(df, "at", ["v", "word", "nothing"]), path)
    return path


def batch(spark, days=30, rows=20_000, shift=0):
    return spark.range(rows).select(
        F.expr(f"timestamp'2024-01-01' + make_interval(0, 0, 0, int(id % {days}))").alias("at"),
        F.when(F.col("id") % 10 > 0, F.pow(F.rand(3), 3) * 1000 + shift).alias("v"),
        F.concat(F.lit("w"), F.col("id") % 700).alias("word"),
        F.lit(None).cast("long").alias("nothing"),
    )


def test_any_range_within_the_bounds(spark, tmp_path):
    df = batch(spark).cache()
    path = stored(spark, tmp_path, df)
    for first, last in ((date(2024, 1, 1), date(2024, 1, 30)), (date(2024, 1, 7), date(2024, 1, 9)), (date(2024, 1, 30), date(2025, 1, 1))):
        own = df.filter(F.to_date("at").between(F.lit(first), F.lit(last)))
        v = np.sort([r["v"] for r in own.filter("v is not null").collect()])
        got = {r["field"]: r for r in profile_range(read_profiles(spark, path), first, last).collect()}
        assert got["v"]["n_rows"] == got["word"]["n_rows"] == got["nothing"]["n_nulls"] == own.count()
        assert got["v"]["n_nulls"] == own.count() - len(v) and (got["v"]["low"], got["v"]["high"]) == (v[0], v[-1])
        for name, share in QUANTILES.items():
            assert abs(np.searchsorted(v, got["v"][name]) / len(v) - share) <= RANK_ERROR
            assert got["word"][name] is None and got["nothing"][name] is None
        words = own.select("word").distinct().count()
        assert abs(got["word"]["n_distinct"] - words) <= 0.05 * words + 1 and got["nothing"]["n_distinct"] == 0


def test_days_are_replaced_alone(spark, tmp_path):
    path = stored(spark, tmp_path, batch(spark, days=3, rows=300))
    again = batch(spark, days=1, rows=50, shift=5_000)
    store_profiles(daily_profiles(again, "at", ["v", "word", "nothing"]), path)
    (row,) = profile_range(read_profiles(spark, path), date(2024, 1, 1), date(2024, 1, 3)).filter("field = 'v'").collect()
    assert (row["n_days"], row["n_rows"]) == (3, 250) and row["high"] >= 5_000


def test_rows_without_a_time_and_no_rows(spark, tmp_path):
    df = batch(spark, rows=100).withColumn("at", F.when(F.col("word") > "w5", F.col("at")))
    path = stored(spark, tmp_path, df)
    timed = df.filter("at is not null").count()
    (row,) = profile_range(read_profiles(spark, path), date(2024, 1, 1), date(2024, 2, 1)).filter("field = 'v'").collect()
    assert row["n_rows"] == timed < 100
    assert profile_range(read_profiles(spark, path), date(2020, 1, 1), date(2020, 2, 1)).count() == 0


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    path = stored(spark, tmp_path, batch(spark, rows=300))
    plan = profile_range(read_profiles(spark, path), date(2024, 1, 2), date(2024, 1, 3))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_day" in plan
