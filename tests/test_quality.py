import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftgate.operators import (
    amount_bands,
    domain_share,
    domain_violations,
    hour_profile,
    null_profile,
    null_spikes,
    range_violations,
)
from driftgate.settings import PROFILES, Limits, profile
from driftgate.sources import Contract

CONTRACT = Contract.of("things", "id long, name string, note string?", ("id", "name"), ("id",))


def test_null_profile(spark):
    rows = [(1, "a", None), (2, " ", ""), (3, None, None), (4, "b", "x")]
    df = spark.createDataFrame(rows, "id long, name string, note string")
    found = {(r["field"], r["metric"]): (r["n_hits"], r["rate"], r["flagged"]) for r in null_profile(df, CONTRACT).collect()}
    assert found == {
        ("id", "null"): (0, 0.0, False),
        ("name", "null"): (1, 0.25, True),
        ("name", "empty"): (1, 0.25, True),
        ("note", "null"): (2, 0.5, True),
        ("note", "empty"): (1, 0.25, True),
        ("*", "all_null"): (1, 0.25, True),
    }


def test_a_table_of_nothing_but_its_key_has_no_content_check(spark):
    contract = Contract.of("ids", "id long", (), ("id",))
    assert [r["field"] for r in null_profile(spark.range(3), contract).collect()] == ["id"]


def test_a_rate_at_its_limit_is_not_flagged(spark):
    df = spark.range(20).select("id", F.when(F.col("id") > 0, "x").alias("name"), F.lit("y").alias("note"))
    (row,) = null_profile(df, CONTRACT).filter("field = 'name' AND metric = 'null'").collect()
    assert row["rate"] == row["max_rate"] == 0.05 and not row["flagged"]


def test_null_profile_of_an_empty_batch(spark):
    df = spark.createDataFrame([], "id long, name string, note string")
    assert {(r["n_rows"], r["rate"], r["flagged"]) for r in null_profile(df, CONTRACT).collect()} == {(0, 0.0, False)}


def test_several_profiles_share_one_pass(spark, root):
    path = f"{root}/things"
    spark.range(10).select("id", F.lit("a").alias("name"), F.lit("b").alias("note")).write.parquet(path)
    judged = null_profile(spark.read.parquet(path), CONTRACT, PROFILES)
    assert judged._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert judged.select("profile").distinct().count() == len(PROFILES)


def test_profiles_are_immutable():
    assert profile("light").critical_null_rate == 0.02
    assert profile("heavy").with_(null_rate=0.5) != profile("heavy")
    with pytest.raises(ValueError):
        profile("wild")
    with pytest.raises(AttributeError):
        Limits().null_rate = 1.0


def test_null_spikes(spark):
    days = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)]
    rows = [(days[0], None if i < 1 else 1) for i in range(4)] + [(days[1], None if i < 1 else 1) for i in range(5)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v int")
    found = {str(r["day"]): (r["n_nulls"], r["n_rows"], r["spike"]) for r in null_spikes(df, "ts").collect()}
    assert found == {"2024-01-01": (1, 4, True), "2024-01-02": (1, 5, False)}


def test_domain_checks(spark):
    df = spark.createDataFrame([(v,) for v in ["A", "A", "B", "x", "y", "y", None]], "v string")
    assert dict(domain_violations(df, "v", ["A", "B"]).collect()) == {"x": 1, "y": 2}
    shares = {r["value"]: (r["n_rows"], r["expected_share"]) for r in domain_share(df, "v", {"A": 3, "B": 1, "C": 0}).collect()}
    assert shares == {"A": (2, 0.75), "B": (1, 0.25), "C": (0, 0.0), "(other)": (3, 0.0), None: (1, 0.0)}
    assert domain_share(df, "v", {"A": 1}).agg(F.sum("share")).first()[0] == pytest.approx(1)


def test_range_violations(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, "a", 11.0), (3, "b", -1.0), (4, "c", 99.0), (5, "a", None)],
                               "id int, kind string, v double")
    bounds = {"a": (0.0, 10.0), "b": (0.0, 1.0)}
    found = {2: "out_of_range", 3: "out_of_range", 4: "unknown_category"}
    assert {r["id"]: r["reason"] for r in range_violations(df, "kind", "v", bounds).collect()} == found
    frame = spark.createDataFrame([(k, *v) for k, v in bounds.items()], "category string, low double, high double")
    out = range_violations(df, "kind", "v", frame)
    assert {r["id"]: r["reason"] for r in out.collect()} == found
    assert out.columns == ["id", "kind", "v", "low", "high", "reason"]


def test_amount_bands(spark):
    values = [5.0, 99.99, 100.0, 5000.0, 1e6, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = {r["band"]: (r["n_rows"], r["expected_share"]) for r in amount_bands(df, "v").collect()}
    assert found == {0: (2, 0.6), 1: (1, 0.25), 2: (1, 0.12), 4: (1, 0.0), None: (1, 0.0)}


def test_hour_profile(spark):
    rows = [(dt.datetime(2024, 1, 1, h),) for h in (0, 0, 23)] + [(None,)]
    found = {r["hour"]: (r["n_rows"], round(r["expected_share"] * 130)) for r in
             hour_profile(spark.createDataFrame(rows, "ts timestamp_ntz"), "ts").collect()}
    assert found == {0: (2, 1), 23: (1, 2), None: (1, 0)}
