"""Checks on how many rows arrive each day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftgate.functions.columns import col
from driftgate.settings import Limits


def volume_by_day(
    df: DataFrame, ts: str, limits: Limits = Limits(), by: Sequence[str] = (),
    since: str = "1990-01-01", until: str | None = None,
) -> DataFrame:
    """Rows of each calendar day judged against the mean of the days before it.

    The calendar is the same for every ``by`` group: from the earliest to the latest day of the
    whole table between ``since`` and ``until`` (tomorrow, if not given). Days without rows
    count as zero, so a group that stops shows ``zero`` to the end. A day is judged once it has a
    full trailing window: ``zero``, ``spike`` or ``drop`` in ``flag``, and ``declining`` if it
    ends a streak of days that each fell by the decline rate. Days beyond ``since`` and ``until``
    are counted, flagged ``outside``, and never stretch the calendar; rows without a timestamp
    are counted under a null day, flagged ``undated``. The table is reduced to one row per day,
    per group, before any window runs.
    """
    daily = df.groupBy(*map(col, by), F.to_date(col(ts)).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return judge_days(daily, limits, by, since, until)


def judge_days(
    daily: DataFrame, limits: Limits = Limits(), by: Sequence[str] = (), since: str = "1990-01-01", until: str | None = None,
) -> DataFrame:
    """The same from counts that are there already: one row ``day``, ``n`` per day and ``by`` group."""
    keys = [col(name) for name in by]
    last = F.lit(until).cast("date") if until else F.date_add(F.current_date(), 1)
    usual = F.coalesce(F.col("day").between(F.lit(since).cast("date"), last), F.lit(False))
    inside, beyond = daily.filter(usual), daily.filter(~usual)
    # With the counts in it this subquery reads the same shuffle as the query itself.
    seen_day = F.struct("day", "n")
    span = inside.agg(F.struct(F.min(seen_day).alias("lo"), F.max(seen_day).alias("hi"))).scalar()
    days = Window.partitionBy(*keys).orderBy("day")
    # Each day stretches to the eve of the next one seen, the first and the last to the ends of the calendar.
    first = F.when(F.lag("day").over(days).isNull(), F.col("span.lo.day")).otherwise(F.col("day"))
    eve = F.coalesce(F.date_sub(F.lead("day").over(days), 1), F.col("span.hi.day"))
    spine = inside.withColumn("span", span).select(*keys, "day", "n", first.alias("first"), eve.alias("eve")).select(
        *keys, F.explode(F.sequence("first", "eve")).alias("date"), "day", "n"
    )
    filled = spine.select(
        *keys, F.col("date").alias("day"), F.when(F.col("date") == F.col("day"), F.col("n")).otherwise(0).alias("n")
    )
    trailing = days.rowsBetween(-limits.trailing_days, -1)
    streak = days.rowsBetween(1 - limits.decline_days, 0)
    fell = F.col("n") <= (1 - limits.decline_rate) * F.lag("n").over(days)
    measured = (
        filled.withColumn("fell", F.coalesce(fell.cast("int"), F.lit(0)))
        .withColumn("seen", F.count("n").over(trailing))
        .withColumn("trailing_mean", F.avg("n").over(trailing))
        .withColumn("falls", F.sum("fell").over(streak))
    )
    flag = (
        F.when(F.col("n") == 0, "zero")
        .when(F.col("n") >= limits.volume_spike * F.col("trailing_mean"), "spike")
        .when(F.col("n") <= limits.volume_drop * F.col("trailing_mean"), "drop")
    )
    judged = measured.filter(F.col("seen") == limits.trailing_days).select(
        *keys,
        "day",
        F.col("n").alias("n_rows"),
        "trailing_mean",
        flag.alias("flag"),
        (F.col("falls") == limits.decline_days).alias("declining"),
    )
    return judged.unionByName(
        beyond.select(
            *keys,
            "day",
            F.col("n").alias("n_rows"),
            F.lit(None).cast("double").alias("trailing_mean"),
            F.when(F.col("day").isNull(), "undated").otherwise("outside").alias("flag"),
            F.lit(False).alias("declining"),
        )
    )
