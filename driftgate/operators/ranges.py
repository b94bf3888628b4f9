"""Profiles of any range of days, merged from what is stored of each day.

A day is reduced once, to a row for each column: counts, extremes, a HyperLogLog sketch of the distinct values and, for
numbers, a KLL sketch of the quantiles. Sketches have a fixed size whatever the day holds and merge without loss of
accuracy, so a range of a year reads a year of such rows and none of the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftgate.functions.columns import col

#: Accuracy of the sketches: k of KLL (ranks within ``RANK_ERROR``), log2 of HyperLogLog's buckets (1.6 %).
KLL_K = 200
RANK_ERROR = 0.02
HLL_BITS = 12
QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _day_facts(field: T.StructField) -> Column:
    value = col(field.name)
    number = isinstance(field.dataType, T.NumericType)
    as_double = value.cast("double") if number else F.lit(None).cast("double")
    return F.struct(
        F.lit(field.name).alias("field"),
        F.count("*").alias("n_rows"),
        F.count_if(value.isNull()).alias("n_nulls"),
        F.min(as_double).alias("low"),
        F.max(as_double).alias("high"),
        F.hll_sketch_agg(value.cast("string"), F.lit(HLL_BITS)).alias("distinct"),
        (F.kll_sketch_agg_double(as_double, F.lit(KLL_K)) if number else F.lit(None).cast("binary")).alias("quantiles"),
    )


def daily_profiles(df: DataFrame, time: str, fields: Sequence[str]) -> DataFrame:
    """One row for each day of ``time`` and column of ``fields``, in one aggregate that combines before it shuffles.

    Rows without a time have the day null. ``low``, ``high`` and ``quantiles`` are null for columns that are no numbers.
    """
    facts = F.array(*[_day_facts(df.schema[name]) for name in fields])
    grouped = df.groupBy(F.to_date(col(time)).alias("_day")).agg(facts.alias("facts"))
    return grouped.select("_day", F.inline("facts"))


def store_profiles(profiles: DataFrame, path: str) -> None:
    """Write the days of ``profiles``; stored days among them are replaced, others stay."""
    (
        profiles.repartition("_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("_day").parquet(path)
    )


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "field string, n_rows long, n_nulls long, low double, high double, distinct binary, quantiles binary, _day date"
    )
    return spark.read.schema(schema).parquet(path)


def profile_range(stored: DataFrame, first: date, last: date) -> DataFrame:
    """The profile of each column over the days ``first`` to ``last``: field, n_days, n_rows, n_nulls, low, high,
    n_distinct (estimated) and quantiles (null where there are no numbers). A range without rows has no profile."""
    merged = (
        stored.filter(F.col("_day").between(F.lit(first), F.lit(last)))
        .groupBy("field")
        .agg(
            F.count_distinct("_day").alias("n_days"),
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_nulls").alias("n_nulls"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
            F.kll_merge_agg_double("quantiles").alias("quantiles"),
        )
    )
    some = F.col("low").isNotNull()
    at = [
        F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(share))).alias(name)
        for name, share in QUANTILES.items()
    ]
    return merged.select("*", *at).drop("quantiles")
