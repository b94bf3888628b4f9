import random
from collections import Counter

from pyspark.sql import functions as F

from driftgate.operators import key_duplicates, orphan_keys, orphan_summary


def tables(spark):
    random.seed(3)
    # A third of the rows share one orphan key, another third one known key.
    keys = [999] * 200 + [1] * 200 + [random.randrange(40) for _ in range(195)] + [None] * 5
    child = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, fk long")
    parent = spark.range(30).select(F.col("id").alias("pk"))
    return keys, child, parent.union(parent)


def test_orphans_against_brute_force(spark):
    keys, child, parent = tables(spark)
    expected = Counter(k for k in keys if k is not None and k >= 30)
    assert dict(orphan_keys(child, "fk", parent, "pk").collect()) == expected
    row = orphan_summary(child, "fk", parent, "pk").first()
    assert tuple(row) == (595, sum(expected.values()), len(expected))


def test_no_rows(spark):
    _, child, parent = tables(spark)
    assert tuple(orphan_summary(child.limit(0), "fk", parent, "pk").first()) == (0, 0, 0)


def test_references_are_counted_before_they_are_shuffled(spark):
    _, child, parent = tables(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = orphan_keys(child, "fk", parent, "pk")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan.index("SortMergeJoin")
    assert "LeftOuter" in plan and plan.index("partial_count") > join
    assert plan.count("Exchange") == 2


def test_key_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1)], "a int, b int")
    assert {tuple(r) for r in key_duplicates(df, ["a", "b"]).collect()} == {(1, 1, 2), (2, 1, 3)}
    plan = key_duplicates(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
