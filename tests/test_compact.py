import pytest
from pyspark.sql import functions as F

from driftgate.operators import detect, heal
from driftgate.plans import stored_quarantines
from driftgate.sources import Contract, RunStore

THINGS = Contract.of("odd things/é%+=x", "id bigint, v double", ("id", "v"), ("id",))


def rows(spark, n, parts, bad=True):
    value = F.when(F.col("id") % 2 == 0, F.lit("x" if bad else "1")).otherwise(F.lit("2"))
    return spark.range(0, n, 1, parts).select("id", value.alias("v"))


@pytest.fixture()
def store(spark, root):
    return RunStore(spark, root)


def split(store, df, run_id):
    found = detect(df, THINGS, run_id, "2024-01-01 00:00:00")
    store.write_split(heal(df, THINGS, found), run_id)


def test_a_thousand_small_files(spark, store):
    split(store, rows(spark, 4000, 1000), "run_1")
    before = sorted(store.quarantine("run_1").collect())
    kept = sorted(store.clean("run_1").collect())
    assert len(store.quarantine("run_1").inputFiles()) == 1000 and len(before) == 2000
    assert store.compact("run_1") == 1
    assert len(store.quarantine("run_1").inputFiles()) == 1
    assert sorted(store.quarantine("run_1").collect()) == before and sorted(store.clean("run_1").collect()) == kept
    assert len(store.clean("run_1").inputFiles()) == 1000  # the other part is as it was
    assert store.compact("run_1") == 1  # nothing left to do


def test_files_of_a_size(spark, store):
    split(store, rows(spark, 400, 40), "run_1")
    files = spark.read.format("binaryFile").load(store.quarantine_path(THINGS.entity, "run_1").replace("%", "\\%"))
    assert 2 <= store.compact("run_1", file_bytes=files.agg(F.sum("length")).first()[0] // 4) <= 5
    assert store.quarantine("run_1").count() == 200 and 2 <= len(store.quarantine("run_1").inputFiles()) <= 5


def test_nothing_to_compact(spark, store):
    split(store, rows(spark, 10, 2, bad=False), "run_1")
    assert store.compact("run_1") == 0 and store.compact("run_2", "nobody") == 0


def test_partitions_follow_the_folders(spark, store):
    assert store.partitions().count() == 0
    split(store, rows(spark, 10, 2), "run_1")
    split(store, rows(spark, 10, 2), "run_2")
    of = THINGS.entity
    both = {(of, r, d) for r in ("run_1", "run_2") for d in ("clean", "quarantine")}
    assert {tuple(r) for r in store.partitions().collect()} == both
    split(store, rows(spark, 10, 2, bad=False), "run_1")  # the run again, on better data
    assert {tuple(r) for r in store.partitions().collect()} == both - {(of, "run_1", "quarantine")}
    assert store.quarantined_runs(5) == ["run_2"]
    assert [tuple(r) for r in stored_quarantines(store).select("run_id", "entity", "n_rows").collect()] == [("run_2", of, 5)]
