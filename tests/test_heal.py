import pytest
from pyspark.sql import functions as F

from driftgate.operators import add_column, detect, drop_column, heal, retype_to_string
from driftgate.operators.detect import ANOMALY_FIELDS
from driftgate.settings import FILL_NULL, QUARANTINE_ROWS, RETYPED_UNSAFE
from driftgate.sources import Contract
from tests.test_queries import SMALL
from workload.tables import EVENTS, LINEITEM, events_drifted, events_unsafe, lines_unsafe, table

CONTRACT = Contract.of("things", "id long, a double, b double, when timestamp?, name string?",
                       ("id",), ("id",))


def healed(df, contract, **kwargs):
    return heal(df, contract, detect(df, contract, "run_1", "now"), **kwargs)


def test_clean_and_quarantine_part_the_batch(spark):
    batch = events_unsafe(spark, SMALL)
    result = healed(batch, EVENTS)
    clean = {r[0] for r in result.clean.select("event_id").collect()}
    held = {r[0] for r in result.quarantine.select("event_id").collect()}
    assert clean and held and not clean & held
    assert clean | held == {r[0] for r in batch.select("event_id").collect()}


def test_healed_batch_has_no_column_drift(spark):
    clean = healed(events_drifted(spark, SMALL), EVENTS).clean
    again = detect(clean, EVENTS, "run_1", "now").collect()
    assert [r["field"] for r in again] == ["value"]
    assert clean.columns == list(EVENTS.types())


@pytest.mark.parametrize("partitions", [1, 2, 4])
def test_partitioning_does_not_change_the_split(spark, partitions):
    batch = table(spark, SMALL, "events").repartition(partitions)
    drifted = retype_to_string(batch, "value", EVENTS.key, corrupt=True)
    expected = healed(events_unsafe(spark, SMALL), EVENTS).quarantine.select("event_id", "value")
    ours = healed(drifted, EVENTS).quarantine.select("event_id", "value")
    assert sorted(ours.collect()) == sorted(expected.collect())


def test_row_with_two_bad_values_keeps_both_reasons(spark):
    rows = [(1, "x", "y"), (2, "1", "y"), (3, "1", "2"), (4, None, "2"), (5, "x", None)]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    result = healed(df, CONTRACT)
    held = {r["id"]: r for r in result.quarantine.collect()}
    assert {k: r["_quarantine_reasons"] for k, r in held.items()} == {
        1: ["unparseable:a", "unparseable:b"], 2: ["unparseable:b"], 5: ["unparseable:a"],
    }
    assert {k: r["_quarantine_reason"] for k, r in held.items()} == {
        1: "unparseable:a", 2: "unparseable:b", 5: "unparseable:a",
    }
    assert sorted(r["id"] for r in result.clean.collect()) == [3, 4]
    by_reason = result.quarantine_by_reason
    assert by_reason.columns == ["id", "a", "b", "when", "name", "reason"]
    assert sorted((r["id"], r["reason"]) for r in by_reason.collect()) == [
        (1, "unparseable:a"), (1, "unparseable:b"), (2, "unparseable:b"), (5, "unparseable:a"),
    ]


def test_null_fill_has_the_contract_type_and_place(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, "n", "m")], "id long, a double, b double, name string, _batch string")
    clean = healed(df, CONTRACT).clean
    assert clean.columns == ["id", "a", "b", "when", "name", "_batch"]
    assert dict(clean.dtypes)["when"] == "timestamp"
    assert clean.first()["when"] is None


def test_whole_batch_is_kept_as_it_came(spark):
    df = add_column(drop_column(table(spark, SMALL, "events"), "value"), "loyalty_tier", "string", "GOLD")
    result = healed(drop_column(df, "props"), EVENTS)
    assert result.clean is None
    held = result.quarantine
    assert held.columns == ["event_id", "ts", "user_id", "event_type", "loyalty_tier",
                            "_quarantine_reason", "_quarantine_reasons"]
    assert held.count() == df.count()
    reason = "full_batch:schema_drift_column_removed_critical"
    assert held.select("_quarantine_reason").distinct().collect() == [(reason,)]


def test_retyped_column_stays_text_unless_cast(spark):
    batch = events_unsafe(spark, SMALL)
    assert dict(healed(batch, EVENTS).clean.dtypes)["value"] == "string"
    cast = healed(batch, EVENTS, on_safe="cast").clean
    assert dict(cast.dtypes)["value"] == "double"
    assert detect(cast, EVENTS, "run_1", "now").count() == 0
    assert cast.filter(F.col("value").isNull()).count() == 0


def test_casting_loses_no_value(spark):
    contract = Contract.of("typed", "id long, born date, size integer, tags string", (), ("id",))
    rows = [(1, "2024-01-31", "7", 5), (2, "N/A", "7", 5), (3, "2024-01-31", "1.5", 5), (4, None, None, 5)]
    df = spark.createDataFrame(rows, "id long, born string, size string, tags int")
    anomalies = detect(df, contract, "run_1", "now")
    assert {r["severity"] for r in anomalies.collect()} == {"MEDIUM"}
    result = heal(df, contract, anomalies, on_safe="cast")
    assert dict(result.clean.dtypes) == {"id": "bigint", "born": "date", "size": "int", "tags": "int"}
    assert [tuple(map(str, r)) for r in result.clean.orderBy("id").collect()] == [
        ("1", "2024-01-31", "7", "5"), ("4", "None", "None", "5"),
    ]
    held = {r["id"]: r["_quarantine_reasons"] for r in result.quarantine.collect()}
    assert held == {2: ["unparseable:born"], 3: ["unparseable:size"]}


def test_quarantine_lacks_the_added_column(spark):
    held = healed(events_drifted(spark, SMALL), EVENTS).quarantine
    assert "loyalty_tier" not in held.columns and "props" in held.columns


def test_anomalies_may_be_plain_mappings(spark):
    df = spark.createDataFrame([(1, "x")], "id long, a string")
    anomalies = [
        {"anomaly_type": RETYPED_UNSAFE, "field": "a", "action": QUARANTINE_ROWS},
        {"anomaly_type": "other", "field": "name", "action": FILL_NULL},
    ]
    assert heal(df, CONTRACT, anomalies).quarantine.count() == 1


def test_nothing_to_do(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, None, "n")], CONTRACT.schema)
    result = healed(df, CONTRACT)
    assert result.quarantine.count() == 0 and result.clean.collect() == df.collect()


def test_bad_arguments(spark):
    df = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(ValueError):
        heal(df, CONTRACT, [], on_safe="maybe")
    with pytest.raises(ValueError):
        heal(df, CONTRACT, [{"anomaly_type": "x", "field": "id", "action": "explode"}])


def test_each_value_is_parsed_once_when_labelled(spark):
    batch = lines_unsafe(spark, SMALL)
    plan = healed(batch, LINEITEM).labelled()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("try_cast(") == 2


def test_null_values_are_skipped_at_the_scan(spark, root):
    path = f"{root}/batch"
    spark.createDataFrame([(1, "x", None)], "id long, a string, b double").write.parquet(path)
    plan = healed(spark.read.parquet(path), CONTRACT).quarantine._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [IsNotNull(a)]" in plan.toString()


def test_anomaly_fields_are_the_documented_nine():
    assert len(ANOMALY_FIELDS) == 9


def test_a_plain_heal_keeps_dates_that_a_wider_probe_passed(spark):
    contract = Contract.of("days", "id long, day date", ("id",), ("id",))
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "junk"), (3, "2024-02-29")], "id long, day string")
    found = detect(rows, contract, "r", "2024-01-31 12:00:00", probe="all")
    assert [r["id"] for r in heal(rows, contract, found).quarantine.collect()] == [2]
