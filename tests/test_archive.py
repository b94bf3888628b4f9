import pytest
from pyspark.sql import functions as F

from driftgate.plans import archived_views, recent_runs
from driftgate.sources import RunStore


def runs(spark, days, per_day):
    """Rows of a pipeline log: ``per_day`` runs on each day of January 2024 in ``days``."""
    at = F.concat(F.format_string("2024-01-%02d ", F.col("d")), F.format_string("%02d:00:00", F.col("i")))
    return spark.createDataFrame([(d, i) for d in days for i in range(per_day)], "d int, i int").select(
        F.concat(F.lit("run_"), "d", F.lit("_"), "i").alias("run_id"), F.lit("things").alias("entity"),
        F.lit("added").alias("drift_type"), F.lit(False).alias("force_critical"), F.lit(1).cast("long").alias("anomaly_count"),
        F.lit("LOW").alias("max_severity"), F.lit(0).cast("long").alias("rows_quarantined"),
        F.lit(9).cast("long").alias("rows_surviving"), F.lit("text").alias("summary_text"), at.alias("completed_at"),
        F.lit("path").alias("drifted_path"),
    )


@pytest.fixture()
def store(spark, root):
    return RunStore(spark, root)


def days_of(store):
    return {r["_day"]: r["n"] for r in store.archived("pipeline_log").groupBy("_day").agg(F.count("*").alias("n")).collect()}


def test_newest_days_that_fill_the_view(spark, store):
    log = runs(spark, range(1, 21), 3)
    store.archive_log("pipeline_log", rows=log)
    newest = store.newest("pipeline_log", 10)
    assert {r["completed_at"][:10] for r in newest.collect()} == {f"2024-01-{d}" for d in range(17, 21)}
    assert recent_runs(newest).collect() == recent_runs(log).collect()
    assert len(newest.inputFiles()) == 20  # all are listed, few are read
    assert store.newest("pipeline_log", 61).count() == 60


def test_days_are_pruned(spark, store, capsys):
    store.archive_log("pipeline_log", rows=runs(spark, range(1, 21), 3))
    recent_runs(store.newest("pipeline_log", 10)).explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(_day" in plan and ">= 2024-01-17" in plan


def test_some_days_are_replaced(spark, store):
    store.archive_log("pipeline_log", rows=runs(spark, range(1, 6), 3))
    store.archive_log("pipeline_log", "2024-01-02", "2024-01-03", rows=runs(spark, range(1, 6), 1))
    assert days_of(store) == {f"2024-01-0{d}": 1 if d in (2, 3) else 3 for d in range(1, 6)}
    store.archive_log("pipeline_log", rows=runs(spark, [7], 2))
    assert days_of(store) == {"2024-01-07": 2}


def test_from_the_stores_own_log(spark, store):
    for day in (1, 2):
        store.append_log("pipeline_log", runs(spark, [day], 1), f"run_{day}", "things")
    store.archive_log("pipeline_log")
    assert days_of(store) == {"2024-01-01": 1, "2024-01-02": 1}
    assert sorted(r["run_id"] for r in store.newest("pipeline_log", 5).collect()) == ["run_1", "run_2"]


def test_nothing_archived(store):
    assert all(view.count() == 0 for view in archived_views(store).values())


def test_rows_without_a_time(spark, store):
    log = runs(spark, [1], 2).withColumn("completed_at", F.when(F.col("run_id") == "run_1_0", F.col("completed_at")))
    store.archive_log("pipeline_log", rows=log)
    assert store.newest("pipeline_log", 5).count() == 2
