"""Tables of several hundred columns plan and run like narrow ones."""

from datetime import datetime

from pyspark.sql import functions as F

from driftgate.operators import null_profile
from driftgate.plans import run_batch
from driftgate.sources import Contract, RunStore

WIDTH = 250
CONTRACT = Contract.of(
    "wide", "id long, " + ", ".join(f"c{i} double" for i in range(WIDTH)), ("id",), ("id",)
)


def batch(spark):
    names = [f"IF(id % 50 = {i}, 'x', '1') AS c{i}" for i in range(WIDTH)]
    return spark.range(100).selectExpr("id", *names)


def test_every_column_may_hold_bad_values(spark, root):
    record = run_batch(RunStore(spark, root), batch(spark), CONTRACT, "w", datetime(2024, 1, 1)).record
    assert (record["anomaly_count"], record["rows_quarantined"]) == (WIDTH, 100)


def test_null_profile(spark):
    wide = batch(spark).select("id", *[F.nullif(f"c{i}", F.lit("x")).alias(f"c{i}") for i in range(WIDTH)])
    profile = null_profile(wide, CONTRACT).filter("metric = 'null' AND n_hits > 0")
    assert {r["field"]: r["n_hits"] for r in profile.collect()} == {f"c{i}": 2 for i in range(50)}
