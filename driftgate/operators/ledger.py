"""Keys of every run, kept in buckets, so that a batch is checked against history without moving history.

A table has one row per key and run, bucketed by the key and partitioned by run. A batch is reduced to one row per key
and shuffled once, into as many parts as the table has buckets; the stored rows are then grouped and joined where they
lie. A key that half the rows share is one row before anything moves. Where the batch's keys are few enough for Spark to
broadcast, not even they are shuffled. Recording a run again replaces its own partition.

Keys are compared as JSON objects of their texts, so null equals null here, as in ``key_duplicates``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftgate.functions.columns import col

_SCHEMA = "_key STRING, _n_rows BIGINT, _run_id STRING"


def _exact(df: DataFrame, name: str) -> Column:
    """A column as its JSON tells all values apart: texts of times would otherwise end at the millisecond."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.BinaryType):
        return F.hex(name).alias(name)
    nested = isinstance(kind, (T.StructType, T.ArrayType))
    return F.col(name) if nested else F.col(name).cast("string").alias(name)


class KeyLedger:
    """The keys of a dataset, stored under ``path``. ``buckets`` is fixed when the ledger is first used: some hundred
    megabytes of keys to a bucket, over all runs that are checked together, is a good size."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int = 200):
        self.spark = spark
        self.key = list(key)
        self.buckets = buckets
        # Makes the folder, and leaves one that is there as it is.
        spark.createDataFrame([], _SCHEMA).write.mode("append").partitionBy("_run_id").parquet(path)
        # The catalog only has to know the layout; any session can describe the same folder again.
        self.table = f"driftgate_keys_{hashlib.md5(f'{path} {buckets}'.encode()).hexdigest()}"
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({_SCHEMA}) USING parquet PARTITIONED BY (_run_id) "
            f"CLUSTERED BY (_key) INTO {int(buckets)} BUCKETS LOCATION '{place}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {self.table}")

    def _counted(self, df: DataFrame) -> DataFrame:
        """One row per key of ``df``, in the parts that the buckets have."""
        values = [col(c).alias(f"_value_{i}") for i, c in enumerate(self.key)]
        counted = df.select(*values).groupBy(*[f"_value_{i}" for i in range(len(values))]).agg(F.count(F.lit(1)).alias("_n_rows"))
        # Nulls are left out of the object, which tells them from every value.
        parts = [_exact(counted, f"_value_{i}") for i in range(len(values))]
        return counted.withColumn("_key", F.to_json(F.struct(*parts))).repartition(self.buckets, "_key")

    def record(self, df: DataFrame, run_id: str) -> None:
        """Add the keys of a run, or replace them."""
        name = run_id.replace("\\", "\\\\").replace("'", "\\'")
        rows = self._counted(df).select("_key", "_n_rows")
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.table} PARTITION (_run_id = '{name}') SELECT * FROM {{rows}}", rows=rows
        )

    def history(self, but: str | None = None) -> DataFrame:
        """Stored keys, one row each, with their rows and runs, leaving out one run: ``_key, n_earlier, n_runs, first_run``.

        The buckets are the grouping, so nothing is shuffled.
        """
        rows = self.spark.table(self.table)
        if but is not None:
            rows = rows.filter(F.col("_run_id") != but)
        return rows.groupBy("_key").agg(
            F.sum("_n_rows").alias("n_earlier"), F.count(F.lit(1)).alias("n_runs"), F.min("_run_id").alias("first_run")
        )

    def duplicates(self, df: DataFrame, run_id: str | None = None) -> DataFrame:
        """Keys of a batch that occur in it more than once or in any other run: the key, ``n_rows`` in the batch,
        ``n_earlier``, ``n_runs`` and ``first_run`` by id among the others. ``run_id`` is the batch's own, which may be
        recorded already."""
        found = self._counted(df).join(self.history(run_id), "_key", "left")
        nothing = F.lit(0).cast("bigint")
        return found.filter((F.col("_n_rows") > 1) | F.col("n_earlier").isNotNull()).select(
            *[F.col(f"_value_{i}").alias(c) for i, c in enumerate(self.key)],
            F.col("_n_rows").alias("n_rows"),
            F.coalesce("n_earlier", nothing).alias("n_earlier"),
            F.coalesce("n_runs", nothing).alias("n_runs"),
            "first_run",
        )
