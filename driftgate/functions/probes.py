"""Predicates that tell whether text still parses as the type a contract expects."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unparseable(value: Column, target: T.DataType = T.DoubleType()) -> Column:
    """True where ``value`` is present but does not parse as ``target``; never null.

    Text without a digit can only be a double if it spells NaN or infinity. Testing
    that first spares the JVM exception a failed parse costs, which dominates
    when many values are bad.
    """
    failed = value.try_cast(target).isNull()
    if isinstance(target, T.DoubleType):
        failed = F.when(value.rlike("(?i)[0-9]|nan|inf"), failed).otherwise(True)
    return value.isNotNull() & failed


def altered(spark: SparkSession, value: Column, actual: T.DataType, expected: T.DataType) -> Column:
    """True where ``value``, of type ``actual``, is present but would not survive a cast to ``expected``; never null.

    Text has to parse; anything else has to come back as it was. Between types that Spark does not cast or cannot
    compare, nothing survives.
    """
    if isinstance(actual, T.StringType):
        return unparseable(value, expected)

    def kept(value: Column) -> Column:
        return value.eqNullSafe(value.try_cast(expected).try_cast(actual))

    try:
        spark.range(0).select(kept(F.lit(None).cast(actual)))  # analysed, not run
    except AnalysisException:
        return value.isNotNull()
    return value.isNotNull() & ~kept(value)


def parseable(value: Column, target: T.DataType = T.DoubleType()) -> Column:
    """True where ``value`` is null or parses as ``target``."""
    return ~unparseable(value, target)


def reason_text(field: str) -> str:
    # Fixed value: why a row with a value that does not parse is held back.
    return f"unparseable:{field}"


def missing_text(field: str) -> str:
    return f"missing:{field}"


def reasons(bad: Mapping[str, Column]) -> Column:
    """All reasons whose test holds for a row, as an array in the order given."""
    texts = [F.when(test, F.lit(reason)) for reason, test in bad.items()]
    return F.array_except(F.array(*texts), F.array(F.lit(None).cast("string")))


def first_reason(bad: Mapping[str, Column]) -> Column:
    """The first reason whose test holds for a row, null if none does."""
    return F.coalesce(*[F.when(test, F.lit(reason)) for reason, test in bad.items()])


def any_of(tests: Iterable[Column]) -> Column:
    """True where at least one test is true, else false.

    Flat, where a chain of ORs over hundreds of columns would nest too deep to plan.
    """
    tests = list(tests)
    if len(tests) == 1:
        return tests[0]
    return F.coalesce(*[F.when(test, F.lit(True)) for test in tests], F.lit(False))
