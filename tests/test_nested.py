import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftgate.operators import compare_schema, detect, heal
from driftgate.plans import run_batch
from driftgate.sources import Contract, RunStore
from tests.test_runs import NOW

DDL = (
    "id long, p struct<x: double, `a.b`: int, q: struct<z: string, w: double>>, l array<struct<n: int, v: double>>, "
    "m map<string, struct<k: double>>, ll array<array<double>>"
)


@pytest.fixture(scope="module")
def contract(spark):
    return Contract.of("deep", T.StructType.fromDDL(DDL), ("id", "p.q.z"), ("id",))


def kinds(schema, contract, probe="numeric"):
    found = compare_schema(T.StructType.fromDDL(schema), contract, probe)
    return [(f.field, f.anomaly_type[13:], f.probe.simpleString() if f.probe else None) for f in found]


def test_no_drift_for_the_same_schema_in_another_order(contract):
    other = DDL.replace("x: double, `a.b`: int", "`a.b`: int, x: double")
    assert kinds(DDL, contract) == kinds(other, contract) == []


def test_differences_inside(contract):
    drifted = (
        "id long, p struct<x: string, q: struct<w: double, more: int>>, l array<struct<n: int, v: string, `new.n`: int>>, "
        "m map<string, struct<k: string>>, ll array<array<string>>"
    )
    assert kinds(drifted, contract) == [
        ("l.element.`new.n`", "column_added", None), ("p.q.more", "column_added", None),
        ("p.`a.b`", "column_removed_non_critical", None), ("p.q.z", "column_removed_critical", None),
        ("l.element.v", "type_change_safe", "double"), ("ll.element.element", "type_change_safe", "double"),
        ("m.value.k", "type_change_safe", "double"), ("p.x", "type_change_safe", "double"),
    ]


def test_other_shapes_drift_as_a_whole(contract):
    drifted = "id long, p string, l struct<n: int>, m map<int, struct<k: double>>, ll array<double>"
    assert kinds(drifted, contract, "all") == [
        ("l", "type_change_safe", None), ("ll.element", "type_change_safe", None), ("m", "type_change_safe", None),
        ("p", "type_change_safe", None),
    ]


SLACK = (
    "id long, p struct<x: string, extra: int, `a.b`: int, q: struct<z: string>>, "
    "l array<struct<v: string, n: int, t: string>>, m map<string, struct<k: string>>, ll array<array<string>>"
)
GOOD = (1, ("1.5", 9, 2, ("z",)), [("2.5", 1, "t"), (None, 2, "t")], {"a": ("3.5",), "b": None}, [["4.5", None], None, []])
ROWS = [
    GOOD,
    (2, ("x", 9, 2, ("z",)), [], {}, []),
    (3, None, None, None, None),
    (4, ("1", 9, 2, None), [None, ("1", 1, "t"), ("y", 1, "t")], {"a": ("1",), "b": ("z",)}, [["1"], ["w"]]),
]


def test_heal_rebuilds_in_place(spark, contract):
    df = spark.createDataFrame(ROWS, SLACK)
    found = detect(df, contract, "run_1", "now")
    texts = {r["field"]: r["details"] for r in found.collect()}
    assert texts["l.element.v"].endswith("(1 unparseable values)") and texts["ll.element.element"].endswith("(1 unparseable values)")
    healed = heal(df, contract, found)
    kept = healed.clean
    assert sorted(r["id"] for r in kept.collect()) == [1, 3]
    wanted = T.StructType.fromDDL(SLACK.replace(" extra: int,", "").replace(", t: string", "").replace("q: struct<z: string>", "q: struct<z: string, w: double>").replace("v: string, n: int", "n: int, v: string"))
    assert kept.schema.simpleString() == wanted.simpleString()
    one = kept.filter("id = 1").first()
    assert one["p"] == ("1.5", 2, ("z", None)) and one["l"] == [(1, "2.5"), (2, None)]
    assert kept.filter("id = 3").first()[1:] == (None, None, None, None)
    held = {r["id"]: r["_quarantine_reasons"] for r in healed.quarantine.collect()}
    assert held == {
        2: ["unparseable:p.x"],
        4: ["unparseable:l.element.v", "unparseable:ll.element.element", "unparseable:m.value.k"],
    }


def test_cast_gives_the_contracts_types(spark, contract):
    df = spark.createDataFrame(ROWS, SLACK)
    kept = heal(df, contract, detect(df, contract, "run_1", "now"), on_safe="cast").clean
    assert kept.schema.simpleString() == contract.schema.simpleString()
    one = kept.filter("id = 1").first()
    assert one["p"]["x"] == 1.5 and one["l"] == [(1, 2.5), (2, None)] and one["m"] == {"a": (3.5,), "b": None}
    assert one["ll"] == [[4.5, None], None, []]
    assert detect(kept, contract, "run_2", "now").count() == 0


@pytest.mark.parametrize("on_safe", ["keep", "cast"])
def test_a_run_over_nested_drift(spark, contract, root, on_safe):
    store = RunStore(spark, root)
    record = run_batch(store, spark.createDataFrame(ROWS, SLACK), contract, "deep", NOW, on_safe=on_safe).record
    assert (record["rows_surviving"], record["rows_quarantined"], record["max_severity"]) == (2, 2, "CRITICAL")
    assert sorted(r["id"] for r in store.clean("run_deep").collect()) == [1, 3]
    held = {r["id"]: r for r in store.quarantine("run_deep").collect()}
    assert held[2]["p"]["x"] == "x" and held[4]["m"]["b"]["k"] == "z"


def test_a_lost_critical_field_inside_holds_back_the_batch(spark, contract):
    df = spark.createDataFrame(ROWS, SLACK).withColumn("p", F.col("p").dropFields("q"))
    found = detect(df, Contract.of("deep", contract.schema, ("id", "p.q"), ("id",)), "run_1", "now")
    healed = heal(df, contract, found)
    assert healed.clean is None
    assert {r["_quarantine_reason"] for r in healed.quarantine.collect()} == {"full_batch:schema_drift_column_removed_critical"}


def test_heal_tests_for_what_was_found(spark):
    numbers = Contract.of("numbers", "id long, v integer", ("id",), ("id",))
    df = spark.createDataFrame([(1, "1"), (2, "2.5"), (3, "x"), (4, "99999999999")], "id long, v string")
    for probe, held in (("numeric", [3]), ("all", [2, 3, 4])):
        found = detect(df, numbers, "run_1", "now", probe)
        assert [r["id"] for r in heal(df, numbers, found).quarantine.orderBy("id").collect()] == held
        rows = found.collect()
        assert [r["id"] for r in heal(df, numbers, rows, probe=probe).quarantine.orderBy("id").collect()] == held
