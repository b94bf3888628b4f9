from dataclasses import replace

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftgate.operators import assess, assess_as_of, detect_as_of
from driftgate.sources import Contract, MissingContractError, contract_versions, snapshot_frame

OLD = Contract.of("things", "id bigint, a string", ("id",), ("id",))
MID = Contract.of("things", "id bigint, a double, b int?", ("id",), ("id",))
NEW = Contract.of("things", "id bigint, a int, c string", ("id", "c"), ("id",))
ROWS = [
    ("r1", "2024-01-01 00:00:00", 1, "x"), ("r2", "2024-01-02 00:00:00", 2, "x"), ("r2", "2024-01-02 00:00:00", 3, "1.5"),
    ("r3", "2024-01-03 00:00:00", 4, "1.5"), ("r4", "2024-01-01 23:59:59", 5, "y"),
]


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame(ROWS, "run string, at string, id long, a string")


@pytest.fixture(scope="module")
def snapshots(spark):
    saved = [
        (OLD, "2024-01-01 00:00:00", "9.0"), (OLD, "2024-01-01 12:00:00", "9.0"), (OLD, "2024-01-02 00:00:00", "9.9"),
        (MID, "2024-01-02 00:00:00", "10.0"), (NEW, "2024-01-02 00:00:01", "11.0"),
        (replace(NEW, entity="others"), "2020-01-01 00:00:00", "1.0"),
    ]
    frames = [snapshot_frame(spark, [c], since, v) for c, since, v in saved]
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.union(f)
    return whole


def test_versions_in_order_without_repeats(snapshots):
    found = contract_versions(snapshots, "things")
    assert [(v.since, v.version) for v in found] == [
        ("2024-01-01 00:00:00", "9.0"), ("2024-01-02 00:00:00", "10.0"), ("2024-01-02 00:00:01", "11.0"),
    ]
    assert [v.contract for v in found] == [OLD, MID, NEW]
    assert contract_versions(snapshots, "nobody") == []


def test_each_run_by_the_contract_of_its_time(batch, snapshots):
    own = batch.withColumnRenamed("run", "_run_id").withColumnRenamed("at", "_at")
    found = assess_as_of(own, snapshots, "things", F.col("_run_id"), F.col("_at"))
    by = {r["run_id"]: r for r in found.collect()}
    assert {k: r["contract_version"] for k, r in by.items()} == {"r1": "9.0", "r2": "10.0", "r3": "11.0", "r4": "9.0"}
    kinds = {k: [(a["field"], a["anomaly_type"][13:]) for a in r["anomalies"]] for k, r in by.items()}
    assert kinds == {
        "r1": [], "r4": [], "r2": [("b", "column_removed_non_critical"), ("a", "type_change_unsafe")],
        "r3": [("c", "column_removed_critical"), ("a", "type_change_safe")],
    }
    assert {k: (r["rows_total"], r["rows_quarantined"]) for k, r in by.items()} == {
        "r1": (1, 0), "r2": (2, 1), "r3": (1, 1), "r4": (1, 0),
    }


@pytest.mark.parametrize(("run", "contract"), [("r2", MID), ("r3", NEW)])
@pytest.mark.parametrize("probe", ["numeric", "all"])
def test_agrees_with_one_contract(batch, snapshots, run, contract, probe):
    own = batch.filter(F.col("run") == run).withColumnsRenamed({"run": "_r", "at": "_at"})
    one = assess(own, contract, F.col("_r"), F.col("_at"), probe).collect()
    many = assess_as_of(own, snapshots, "things", F.col("_r"), F.col("_at"), probe)
    assert many.drop("contract_version", "contract_since").collect() == one


def test_runs_from_before_the_first_snapshot(batch, snapshots):
    own = batch.withColumnsRenamed({"run": "_r"}).withColumn("_at", F.lit("2023-12-31 00:00:00")).drop("at")
    with pytest.raises(SparkRuntimeException, match="no schema snapshot of things in force at 2023-12-31"):
        detect_as_of(own, snapshots, "things", F.col("_r"), F.col("_at")).collect()
    assert detect_as_of(own, snapshots, "things", F.col("_r"), F.col("_at"), missing="skip").count() == 0
    rows = assess_as_of(own, snapshots, "things", F.col("_r"), F.col("_at"), missing="skip").collect()
    assert len(rows) == 4 and all(r["contract_version"] is None and r["anomalies"] is None for r in rows)
    with pytest.raises(MissingContractError):
        detect_as_of(own, snapshots, "nobody", F.col("_r"), F.col("_at"))
    with pytest.raises(ValueError):
        detect_as_of(own, snapshots, "things", F.col("_r"), F.col("_at"), missing="what")


def test_all_versions_in_one_pass(spark, snapshots, root):
    spark.createDataFrame(ROWS, "_r string, _at string, id long, a string").write.parquet(f"{root}/landing")
    found = detect_as_of(spark.read.parquet(f"{root}/landing"), snapshots, "things", F.col("_r"), F.col("_at"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "ReadSchema: struct<_r:string,_at:string,a:string>" in plan


def test_every_ddl_name():
    ddl = "a int, b bigint?, c smallint NOT NULL, d tinyint not null, e real, f dec(10, 2), g numeric(5,1)?, h TIMESTAMP_LTZ"
    schema = Contract.of("x", ddl, (), ()).schema
    assert [f.dataType for f in schema.fields] == [
        T.IntegerType(), T.LongType(), T.ShortType(), T.ByteType(), T.FloatType(), T.DecimalType(10, 2), T.DecimalType(5, 1),
        T.TimestampType(),
    ]
    assert [f.name for f in schema.fields if f.nullable] == ["b", "g"]
