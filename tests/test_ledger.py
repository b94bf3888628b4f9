import pytest
from pyspark.sql import functions as F

from driftgate.operators import KeyLedger, key_duplicates

DAYS = {
    "run_1": [(1, "a"), (1, "a"), (2, None), (None, None)],
    "run_2": [(2, None), (3, "c"), (None, "x")],
}
TODAY = [(1, "a"), (2, None), (2, "None"), (None, None), (4, "d"), (4, "d"), (5, "e"), (None, "y")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, `part.of` string")


@pytest.fixture()
def ledger(spark, root):
    kept = KeyLedger(spark, f"{root}/keys", ["id", "part.of"], buckets=4)
    for run, rows in DAYS.items():
        kept.record(frame(spark, rows), run)
    yield kept
    spark.sql(f"DROP TABLE {kept.table}")


def test_batch_against_earlier_runs(spark, ledger):
    found = {tuple(r)[:2]: tuple(r)[2:] for r in ledger.duplicates(frame(spark, TODAY)).collect()}
    assert found == {
        (1, "a"): (1, 2, 1, "run_1"), (2, None): (1, 2, 2, "run_1"), (None, None): (1, 1, 1, "run_1"),
        (4, "d"): (2, 0, 0, None),
    }


def test_recording_again_replaces(spark, ledger):
    ledger.record(frame(spark, [(7, "z")]), "run_1")
    ledger.record(frame(spark, TODAY), "it's \\ today")
    found = {tuple(r)[:2]: r["n_runs"] for r in ledger.duplicates(frame(spark, TODAY + [(7, "z")]), "it's \\ today").collect()}
    assert found == {(7, "z"): 1, (2, None): 1, (4, "d"): 0}


def test_another_session_finds_the_folder(spark, root, ledger):
    spark.sql(f"DROP TABLE {ledger.table}")
    again = KeyLedger(spark, f"{root}/keys", ["id", "part.of"], buckets=4)
    assert again.history().agg(F.sum("n_earlier")).first()[0] == 7


def test_no_runs_no_rows(spark, root):
    empty = KeyLedger(spark, f"{root}/none", ["id", "part.of"], buckets=4)
    today = frame(spark, TODAY)
    assert empty.duplicates(today).select("id", "`part.of`", "n_rows").collect() == key_duplicates(
        today, ["id", "part.of"]
    ).collect()
    assert empty.duplicates(today.limit(0)).count() == 0


def test_history_is_not_shuffled(spark, ledger, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ledger.duplicates(frame(spark, TODAY)).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = capsys.readouterr().out.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    (scan,) = [i for i, line in enumerate(lines) if "FileScan parquet" in line]
    above, level = [], depth[scan]
    for i in range(scan, -1, -1):  # the way from the scan up to the root
        if depth[i] < level:
            above.append(lines[i])
            level = depth[i]
    assert any("Join" in line for line in above) and not any("Exchange" in line for line in above)


def test_values_that_look_alike_stay_apart(spark, root):
    kept = KeyLedger(spark, f"{root}/odd", ["at", "raw", "x"], buckets=2)

    def odd(rows):
        sql = ", ".join(f"(timestamp'{at}', X'{raw}', double('{x}'))" for at, raw, x in rows)
        return spark.sql(f"SELECT * FROM VALUES {sql} AS t(at, raw, x)")

    kept.record(odd([("2024-01-01 00:00:00.000001", "FF", "0"), ("2024-01-01 00:00:00", "FE", "NaN")]), "run_1")
    today = [
        ("2024-01-01 00:00:00.000002", "FF", "0"), ("2024-01-01 00:00:00.000001", "FE", "0"),
        ("2024-01-01 00:00:00.000001", "FF", "-0"), ("2024-01-01 00:00:00", "FE", "NaN"),
    ]
    found = kept.duplicates(odd(today)).select(F.hex("raw"), "x", "n_earlier").collect()
    assert sorted((r[0], str(abs(r[1])), r[2]) for r in found) == [("FE", "nan", 1), ("FF", "0.0", 1)]
