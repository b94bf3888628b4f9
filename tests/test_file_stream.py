import glob
import os
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from driftgate.sources import Contract
from driftgate.streaming import gate_files, read_arrived, read_gate, read_gate_anomalies, read_gate_log

THINGS = Contract.of("things", "id long, a double?, b timestamp_ntz?, c string?", ("id", "a"), ("id",))
DAY = datetime(2024, 1, 1)
GOOD = "id long, a double, b timestamp_ntz, c string"


@pytest.fixture()
def land(spark, root):
    def write(rows, schema, name=None):
        folder = f"{root}/landing/{name or schema.replace(':', '')[:20].replace(' ', '_').replace(',', '')}"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        return folder

    return write


def run(spark, root, **options):
    path = f"{root}/landing/*"
    gate_files(spark, path, THINGS, f"{root}/out", f"{root}/check", **options).awaitTermination()
    return f"{root}/out"


def outcomes(spark, out):
    kept = {r["id"]: "clean" for r in read_gate(spark, out, "clean").collect()}
    return kept | {r["id"]: r["_quarantine_reasons"] for r in read_gate(spark, out, "quarantine").collect()}


def test_each_file_by_its_own_schema(spark, root, land):
    land([(1, 1.0, DAY, "x")], GOOD, "good")
    land([(2, DAY, "x", 9)], "id long, b timestamp_ntz, c string, more int", "lost")
    land([(3, "1.5", DAY, "x"), (4, "junk", DAY, "x"), (5, None, DAY, "x")], GOOD.replace("double", "string"), "text")
    land([(6, 2**53, DAY, "x"), (7, 2**53 + 1, DAY, "x")], GOOD.replace("a double", "a long"), "whole")
    land([(8, 1.0, [DAY], "x"), (9, 1.0, None, "x")], GOOD.replace("b timestamp_ntz", "b array<timestamp_ntz>"), "list")
    land([(10, 1.0, DAY)], "id long, a double, b timestamp_ntz", "short")
    land([(None, 1.0, DAY, "x")], GOOD, "unnamed")
    out = run(spark, root)
    assert outcomes(spark, out) == {
        1: "clean", 2: ["full_batch:schema_drift_column_removed_critical"], 3: "clean", 4: ["unparseable:a"], 5: "clean",
        6: "clean", 7: ["unparseable:a"], 8: ["unparseable:b"], 9: "clean", 10: "clean", None: ["missing:id"],
    }
    clean = read_gate(spark, out, "clean")
    assert dict(clean.select("id", "a", "b", "c").dtypes) == {"id": "bigint", "a": "double", "b": "timestamp_ntz", "c": "string"}
    assert {r["id"]: r["a"] for r in clean.collect()}[3] == 1.5
    found = {(r["field"], r["anomaly_type"][13:], r["severity"]) for r in read_gate_anomalies(spark, out).collect()}
    assert found == {
        ("more", "column_added", "LOW"), ("a", "column_removed_critical", "CRITICAL"), ("a", "type_change_unsafe", "CRITICAL"),
        ("b", "type_change_unsafe", "CRITICAL"), ("c", "column_removed_non_critical", "MEDIUM"),
    }
    log = read_gate_log(spark, out).agg(F.sum("rows_total"), F.sum("rows_quarantined")).first()
    assert tuple(log) == (11, 5)
    came = {r["id"]: r["a"] for r in read_arrived(spark, out, "id long, a string").collect()}
    assert came[4] == "junk" and came[7] == str(2**53 + 1)


def test_files_of_one_schema_form_one_group_and_ids_differ_by_group(spark, root, land):
    for i in range(3):
        land([(i, 1.0, DAY, "x", "y")], f"{GOOD}, extra string", "a")
    land([(7, 1.0, DAY, "x", 1)], f"{GOOD}, extra int", "b")
    out = run(spark, root)
    log = spark.read.parquet(f"{out}/log").collect()
    assert sorted(r["n_files"] for r in log) == [1, 3]
    ids = [r["anomaly_id"] for r in read_gate_anomalies(spark, out).collect()]
    assert len(ids) == len(set(ids)) == 2


def test_a_replayed_batch_overwrites_itself(spark, root, land):
    land([(1, 1.0, DAY, "x")], GOOD, "good")
    out = run(spark, root)
    shutil.rmtree(f"{root}/check/commits")
    land([(2, "x", DAY, "x")], GOOD.replace("double", "string"), "text")
    run(spark, root)
    assert outcomes(spark, out) == {1: "clean", 2: ["unparseable:a"]}
    assert read_gate(spark, out, "clean").count() == 1


def test_few_files_at_a_time(spark, root, land):
    for i in range(3):
        land([(i, 1.0, DAY, "x")], GOOD, "good")
    out = run(spark, root, files_per_batch=1)
    assert read_gate(spark, out, "clean").select("_batch_id").distinct().count() == 3


def test_odd_file_names(spark, root, land):
    folder = land([(1, 1.0, DAY, "x")], GOOD, "in")
    spark.createDataFrame([(2, 2.0, DAY, "x")], GOOD).coalesce(1).write.parquet(f"{root}/other")
    (part,) = glob.glob(f"{root}/other/part-*.parquet")
    os.link(part, f"{folder}/odd {{1,2}} [x]%20+ é.parquet")
    assert outcomes(spark, run(spark, root)) == {1: "clean", 2: "clean"}
