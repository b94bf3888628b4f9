"""Checks on keys: references that lead nowhere and keys used more than once.

The referencing side is reduced to one row per key before it is joined, so neither a
key that half the rows share nor a missing parent with many children weighs on one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.functions.columns import col, count_where


def _references(child: DataFrame, fk: str) -> DataFrame:
    """How often each key is referenced; rows without a reference are not counted."""
    return (
        child.filter(col(fk).isNotNull())
        .groupBy(col(fk).alias("key"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def _parents(parent: DataFrame, pk: str) -> DataFrame:
    return parent.select(col(pk).alias("key")).distinct()


def _checked(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Referenced keys with their row count, ``known`` where a parent has the key.

    An outer join rather than an anti join: Spark would move the latter below the
    aggregate and shuffle every referencing row.
    """
    known = _parents(parent, pk).withColumn("known", F.lit(True))
    return _references(child, fk).join(known, "key", "left")


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Referenced keys that have no parent, with the number of rows referencing them."""
    checked = _checked(child, fk, parent, pk)
    return checked.filter(F.col("known").isNull()).select("key", "n_rows")


def orphan_summary(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows with a reference, rows whose reference leads nowhere, and the keys behind them."""
    orphan = F.col("known").isNull()
    nothing = F.lit(0).cast("bigint")
    return _checked(child, fk, parent, pk).agg(
        F.coalesce(F.sum("n_rows"), nothing).alias("n_rows"),
        F.coalesce(F.sum(F.when(orphan, F.col("n_rows"))), nothing).alias("n_orphan_rows"),
        count_where(orphan).alias("n_orphan_keys"),
    )


def key_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    counted = df.groupBy(*map(col, key)).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1)
