import pytest
from pyspark.sql.types import StructType

from driftgate.operators import compare_schema
from driftgate.sources import (
    CONTRACTS,
    Contract,
    MissingContractError,
    latest_by,
    load_contract,
    save_snapshots,
    snapshot_frame,
)
from workload.entities import BASELINES
from workload.tables import TABLE_CONTRACTS, table

SMALL = "/root/testdata/sf0.001"


def test_snapshots_round_trip(spark, root):
    path = f"{root}/snapshots"
    save_snapshots(snapshot_frame(spark, CONTRACTS.values(), "2024-01-01 00:00:00"), path)
    stored = spark.read.parquet(path)
    assert stored.columns[:4] == ["entity_name", "schema_json", "snapshot_timestamp", "version"]
    for entity, contract in CONTRACTS.items():
        loaded = load_contract(stored, entity)
        assert loaded == contract


def test_the_newest_snapshot_is_in_force(spark, root):
    path = f"{root}/snapshots"
    old = Contract.of("things", "id long", ("id",), ("id",))
    new = Contract.of("things", "id long, name string", ("id",), ("id",))
    save_snapshots(snapshot_frame(spark, [new], "2024-02-01 00:00:00", "2.0"), path)
    save_snapshots(snapshot_frame(spark, [old], "2024-01-01 00:00:00", "1.0"), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 2
    assert load_contract(stored, "things", {"things": old}) == new
    assert load_contract(stored, "things", {}) == new
    before = stored.drop("critical_json", "key_json")
    assert load_contract(before, "things", {"things": old}) == new
    assert load_contract(before, "things", {}).critical == frozenset()


def test_same_second_falls_to_the_version(spark):
    old = Contract.of("things", "id long", (), ())
    new = Contract.of("things", "id string", (), ())
    for higher, lower in (("2.0", "1.0"), ("10.0", "9.0"), ("9.10", "9.9"), ("1.0", "draft")):
        both = snapshot_frame(spark, [new], "2024-01-01 00:00:00", higher).union(
            snapshot_frame(spark, [old], "2024-01-01 00:00:00", lower)
        )
        assert load_contract(both, "things").schema == new.schema


def test_decimals_and_nested_types(spark, root):
    plain = Contract.of("things", "id long, price decimal(10, 2)?", ("id",), ("id",))
    assert plain.types()["price"].simpleString() == "decimal(10,2)"
    ddl = "id BIGINT NOT NULL, price DECIMAL(10,2), tags ARRAY<STRING>, at STRUCT<x: INT, y: DOUBLE>"
    nested = Contract.of("nested", StructType.fromDDL(ddl), ("id",), ("id",))
    save_snapshots(snapshot_frame(spark, [plain, nested], "2024-01-01 00:00:00"), f"{root}/snapshots")
    stored = spark.read.parquet(f"{root}/snapshots")
    assert load_contract(stored, "things") == plain and load_contract(stored, "nested") == nested


def test_missing_contract(spark):
    stored = snapshot_frame(spark, CONTRACTS.values(), "2024-01-01 00:00:00")
    with pytest.raises(MissingContractError):
        load_contract(stored, "unknown")
    assert issubclass(MissingContractError, RuntimeError)


def test_critical_fields_belong_to_the_schema():
    for contract in (*CONTRACTS.values(), *TABLE_CONTRACTS.values()):
        assert contract.critical <= set(contract.types())
        assert set(contract.key) <= set(contract.types())


def test_baselines_and_tables_meet_their_contracts(spark):
    for entity, baseline in BASELINES.items():
        assert compare_schema(baseline(spark, SMALL).schema, CONTRACTS[entity]) == []
    for name, contract in TABLE_CONTRACTS.items():
        assert compare_schema(table(spark, SMALL, name).schema, contract) == []


def test_latest_by_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, None)], "k string, t int, v string")
    latest = latest_by(df, ["k"], ["t"])
    assert sorted(map(tuple, latest.collect())) == [("a", 3, "y"), ("b", 2, None)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
