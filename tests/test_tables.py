import pytest

from driftgate.operators import detect, diff_schema_rows, schema_rows
from driftgate.sources import (
    contract_rows,
    local_frame,
    read_table,
    tables_with_prefix,
    workspace,
    write_baseline,
)
from tests.test_queries import SMALL
from workload.tables import EVENTS, events_drifted


class _Conf:
    def __init__(self, settings):
        self._settings = settings

    def get(self, key, default=None):
        return self._settings.get(key, default)


class _Session:
    def __init__(self, **settings):
        self.conf = _Conf({k.replace("_", "."): v for k, v in settings.items()})


def test_workspace_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = workspace(spark, "x"), workspace(spark, "x")
    assert first.startswith(shared) and first != second


def test_workspace_never_falls_back_on_a_cluster():
    with pytest.raises(RuntimeError):
        workspace(_Session(spark_master="yarn"), "x")
    assert workspace(_Session(spark_master="yarn", spark_checkpoint_dir="s3://b/c/"), "x").startswith("s3://b/c/x-")
    assert workspace(_Session(spark_master="local[2]"), "x").startswith("/")


def test_tables_by_name_and_path(spark, root):
    write_baseline(spark.range(3), f"{root}/t")
    write_baseline(spark.range(4), f"{root}/t")
    assert read_table(spark, f"{root}/t").count() == 4
    read_table(spark, f"{root}/t").createOrReplaceTempView("named")
    assert read_table(spark, "named").count() == 4


def test_tables_with_prefix(spark, root):
    for name in ("held_b", "held_a", "other_a"):
        spark.range(1).createOrReplaceTempView(name)
    listed = [r[0] for r in tables_with_prefix(spark, "held_", "default").collect()]
    assert listed == ["held_b", "held_a"]
    assert tables_with_prefix(spark, "held_", "default", 1).count() == 1


def test_local_frame_is_one_partition(spark):
    df = local_frame(spark, {"a": "string", "b": "double"}, [("x", 1.0), ("y", None)])
    assert df.rdd.getNumPartitions() == 1
    assert [tuple(r) for r in df.collect()] == [("x", 1.0), ("y", None)]
    assert df.dtypes == [("a", "string"), ("b", "double")]


def test_catalog_comparison_agrees_with_detection(spark):
    batch = events_drifted(spark, SMALL)
    by_rows = diff_schema_rows(contract_rows(spark, [EVENTS]), schema_rows(batch, "events", EVENTS))
    fields = ["entity", "field", "anomaly_type", "severity", "action"]
    ours = sorted(by_rows.select(fields).collect())
    assert ours == sorted(detect(batch, EVENTS, "r", "now").select(fields).collect())
