import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftgate.functions import unparseable
from driftgate.operators import assess, compare_schema, detect
from driftgate.operators.detect import ANOMALY_FIELDS, in_report_order
from driftgate.settings import (
    ADDED,
    REMOVED,
    REMOVED_CRITICAL,
    RETYPED_SAFE,
    RETYPED_UNSAFE,
    RULES,
)
from driftgate.sources import Contract

CONTRACT = Contract.of(
    "things", "id long, name string?, price double, size integer, born date", ("id", "price"), ("id",)
)


def found(df, contract=CONTRACT, **kwargs):
    rows = detect(df, contract, "run_1", "2024-01-01 00:00:00", **kwargs).collect()
    return [(r["anomaly_type"], r["field"]) for r in rows]


def batch(spark, rows, ddl="id long, name string, price double, size int, born date"):
    return spark.createDataFrame(rows, ddl)


def test_no_drift(spark):
    df = batch(spark, [(1, "a", 1.0, 2, None)])
    anomalies = detect(df, CONTRACT, "run_1", "now")
    assert anomalies.columns == list(ANOMALY_FIELDS) and anomalies.count() == 0


def test_order_and_nullability_do_not_matter(spark):
    schema = T.StructType([f for f in reversed(CONTRACT.schema.fields)])
    for field in schema:
        field.nullable = not field.nullable
    assert compare_schema(schema, CONTRACT) == []


def test_kinds_come_in_report_order(spark):
    df = batch(spark, [(1, 2.0, "x", "7", "y")], "id long, zip double, price string, size string, extra string")
    assert found(df) == [
        (ADDED, "extra"), (ADDED, "zip"), (REMOVED, "born"), (REMOVED, "name"),
        (RETYPED_UNSAFE, "price"), (RETYPED_SAFE, "size"),
    ]


def test_details_severity_and_action(spark):
    df = batch(spark, [(1, "a", "N/A", 2), (2, "b", None, 3), (3, "c", "", 4)],
               "id long, name string, price string, size int")
    rows = in_report_order(detect(df, CONTRACT, "run_1", "2024-01-01 00:00:00")).collect()
    removed, retyped = rows
    assert removed["details"] == "Expected column 'born' missing from source."
    assert retyped["details"] == (
        "Type drift on 'price': expected double, got string (2 unparseable values)"
    )
    for row in rows:
        rule = RULES[row["anomaly_type"]]
        assert (row["severity"], row["action"]) == (rule.severity, rule.action)
        assert (row["run_id"], row["entity"]) == ("run_1", "things")
        assert row["detected_at"] == "2024-01-01 00:00:00"


def test_critical_removal(spark):
    df = batch(spark, [(1,)], "id long")
    assert (REMOVED_CRITICAL, "price") in found(df)


def test_names_match_by_exact_case(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 2, None)], "id long, NAME string, price double, size int, born date")
    assert found(df) == [(ADDED, "NAME"), (REMOVED, "name")]


def test_metadata_columns_are_ignored_on_both_sides(spark):
    contract = Contract.of("things", "id long, _loaded string", (), ("id",))
    df = spark.createDataFrame([(1, "x")], "id long, _source string")
    assert found(df, contract) == []


def test_types_that_differ_only_in_name_rules_do_not_drift():
    kinds = T.StructType().add("a", T.TimestampNTZType()).add("b", T.ArrayType(T.StringType(), False))
    kinds = kinds.add("c", T.MapType(T.StringType(), T.LongType())).add("d", T.DecimalType(10, 2))
    kinds = kinds.add("e", T.StructType().add("x", T.DayTimeIntervalType())).add("f", T.NullType())
    contract = Contract("nested", T.StructType.fromJson(json.loads(kinds.json())), frozenset(), ())
    assert compare_schema(kinds, contract) == []
    loose = T.StructType().add("b", T.ArrayType(T.StringType(), True))
    assert [f.field for f in compare_schema(loose, contract)] == ["a", "c", "d", "e", "f"]


def test_numeric_probe_reads_integers_as_numbers_and_skips_dates(spark):
    df = batch(spark, [(1, "a", 1.0, "1.5", "junk")], "id long, name string, price double, size string, born string")
    assert found(df) == [(RETYPED_SAFE, "born"), (RETYPED_SAFE, "size")]
    assert found(df, probe="all") == [(RETYPED_UNSAFE, "born"), (RETYPED_UNSAFE, "size")]


def test_unknown_probe_is_refused(spark):
    df = batch(spark, [(1, "a", "1", 1, None)], "id long, name string, price string, size int, born date")
    with pytest.raises(ValueError):
        compare_schema(df.schema, CONTRACT, probe="some")


def test_schema_drift_alone_reads_no_data(spark, root):
    path = f"{root}/batch"
    spark.range(10).withColumn("extra", F.lit("x")).write.parquet(path)
    anomalies = detect(spark.read.parquet(path), CONTRACT, "run_1", "now")
    assert "FileScan" not in anomalies._jdf.queryExecution().executedPlan().toString()
    assert anomalies.count() == 5


def test_probe_reads_only_the_retyped_columns(spark, root):
    path = f"{root}/batch"
    rows = [(1, "a", "x", 2, None)]
    batch(spark, rows, "id long, name string, price string, size int, born date").write.parquet(path)
    plan = detect(spark.read.parquet(path), CONTRACT, "r", "now")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "ReadSchema: struct<price:string>" in text and text.count("FileScan") == 1


def test_many_runs_in_one_batch(spark):
    rows = [(1, "a", "x", 1, None, "r1"), (2, "b", "5", 1, None, "r1"), (3, "c", "6", 1, None, "r2")]
    df = batch(spark, rows, "id long, name string, price string, size int, born date, _run string")
    rows = {r["run_id"]: r for r in assess(df, CONTRACT, F.col("_run"), "now").collect()}
    assert {k: (r["rows_total"], r["rows_quarantined"], r["rows_surviving"]) for k, r in rows.items()} == {
        "r1": (2, 1, 1), "r2": (1, 0, 1),
    }
    kinds = {r["run_id"]: r["anomaly_type"] for r in detect(df, CONTRACT, F.col("_run"), "now").collect()}
    assert kinds == {"r1": RETYPED_UNSAFE, "r2": RETYPED_SAFE}


def test_entries_are_not_built_for_every_row(spark):
    df = spark.range(10).select("id", F.col("id").cast("string").alias("_run"))
    plan = detect(df, CONTRACT, F.col("_run"), "now")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange") :]
    assert "sha2" not in below and "Filter" not in below


def test_empty_batch_still_reports_its_schema(spark):
    df = batch(spark, [], "id long, name string, price string, size int, born date")
    assert found(df) == [(RETYPED_SAFE, "price")]


def test_names_with_dots_quotes_and_backticks(spark):
    odd = T.StructType().add("a.b", "double").add("it's", "long").add("c`d", "double")
    contract = Contract("odd", odd, frozenset(), ())
    df = spark.createDataFrame([("x", 1, "2")], T.StructType().add("a.b", "string").add("it's", "long").add("c`d", "string"))
    rows = {r["field"]: r["anomaly_type"] for r in detect(df, contract, "r", "now").collect()}
    assert rows == {"a.b": RETYPED_UNSAFE, "c`d": RETYPED_SAFE}


NUMBERS = ["12.5", "1e3", "+5", " 7 ", "NaN", "Infinity", "-inf", "1.5d", "2f", "nan", "-Infinity", "+INF",
           "١", ".5", "5.", "0x1p3", "1e", "--1", "infinit", "n4n", "NaN1", "\t8\n", "1E400", "-0"]
JUNK = ["N/A", "ERROR", "0x10", "", "1,000", ".", "1_000", "banana", "information", "++", "é", "  "]


def test_probe_agrees_with_the_cast(spark):
    values = spark.createDataFrame([(v,) for v in NUMBERS + JUNK + [None]], "v string")
    cast = F.col("v").isNotNull() & F.col("v").try_cast("double").isNull()
    rows = values.select("v", unparseable(F.col("v")).alias("ours"), cast.alias("plain")).collect()
    assert [r["v"] for r in rows if r["ours"] != r["plain"]] == []
    assert {r["v"] for r in rows if r["ours"]} >= set(JUNK)
    assert not {r["v"] for r in rows if r["ours"]} & set(NUMBERS[:10])


def test_probe_agrees_with_the_cast_on_all_short_texts(spark):
    letters = F.explode(F.split(F.lit("0 1 . + - e d f n a i N I x _ , t y"), " "))
    words = spark.range(1).select(letters.alias("a"))
    for name in ("b", "c"):
        words = words.crossJoin(spark.range(1).select(letters.alias(name)))
    words = words.select(F.concat("a", "b", "c").alias("v"))
    plain = F.col("v").try_cast("double").isNull()
    assert words.filter(unparseable(F.col("v")) != plain).count() == 0
