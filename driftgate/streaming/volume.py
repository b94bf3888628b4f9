"""Rows per time window of a stream, with a watermark for late data.

Every micro-batch writes to a folder of its own, so a replayed one overwrites itself. State is
one count per open window, and per ``by`` group; the watermark closes windows and lets go of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from driftgate.functions.columns import col
from driftgate.operators.volume import judge_days
from driftgate.settings import Limits

_ZONED_EPOCH = "TIMESTAMP'1970-01-01 00:00:00Z'"
_PLAIN_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _clock(stream: DataFrame, ts: str) -> tuple[Column, Callable[[Column], Column]]:
    """The time of a row as watermarks need it, and how to turn such a time back.

    Plain timestamps are counted by their own clock, whatever the session's zone.
    """
    if not isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        return col(ts), lambda time: time
    zoned, plain = F.expr(_ZONED_EPOCH), F.expr(_PLAIN_EPOCH)
    return zoned + (col(ts) - plain), lambda time: plain + (time - zoned)


def count_windows(
    stream: DataFrame,
    ts: str,
    root: str,
    checkpoint: str,
    window: str = "1 day",
    lateness: str = "1 hour",
    by: Sequence[str] = (),
    output_mode: str = "update",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start counting. Rows later than ``lateness`` are left out; the query's progress counts them.

    In ``update`` mode every batch writes the windows it changed, so counts are always current;
    in ``append`` mode a window is written once, when the watermark has passed it.
    Watermarks need timestamps with a zone. Plain ones are counted by their own clock, whatever
    the session's zone, and the windows come back as plain timestamps.
    """
    event_time, plain = _clock(stream, ts)
    start, end = plain(F.col("_window.start")), plain(F.col("_window.end"))
    timed = stream.withColumn("_event_time", event_time)
    counted = (
        timed.withWatermark("_event_time", lateness)
        .groupBy(F.window("_event_time", window).alias("_window"), *map(col, by))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            start.alias("window_start"),
            end.alias("window_end"),
            *map(col, by),
            "n_rows",
        )
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/_batch_id={batch_id}")

    return (
        counted.writeStream.outputMode(output_mode)
        .foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_windows(spark: SparkSession, root: str) -> DataFrame:
    """The final count of each window. Counts only grow, so the largest is the latest."""
    written = spark.read.parquet(root)
    keys = [c for c in written.columns if c not in ("n_rows", "_batch_id")]
    return written.groupBy(*map(col, keys)).agg(F.max("n_rows").alias("n_rows"))


def _before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What the micro-batch before this one wrote under ``path``; None for the first."""
    try:
        return spark.read.parquet(f"{path}/_batch_id={batch_id - 1}")
    except AnalysisException:
        if batch_id == 0:
            return None
    try:
        known = spark.read.parquet(path).filter(F.col("_batch_id") < batch_id)  # a number was skipped
    except AnalysisException:
        return None
    last = known.agg(F.max("_batch_id")).head()[0]
    return None if last is None else known.filter(F.col("_batch_id") == last).drop("_batch_id")


def close_windows(
    stream: DataFrame,
    ts: str,
    root: str,
    checkpoint: str,
    window: str = "1 day",
    lateness: str = "1 hour",
    by: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Count rows per window, emit every window once when the watermark has passed its end, and count what comes later.

    The watermark is the latest time seen up to a micro-batch less ``lateness``; rows of the next one whose window it
    has passed are late. Each micro-batch reduces its rows to a row per window before anything moves, so a window that
    holds most of a day's rows is no hot key, then adds them to the open windows that the one before it left. What it
    closed, left open and found late goes to a folder of its own, so a replay, which starts from the same open windows,
    overwrites itself. Rows without a time belong to no window; they are counted beside.
    """
    event_time, plain = _clock(stream, ts)
    start, end = plain(F.col("_window.start")), plain(F.col("_window.end"))
    keys = ["window_start", "window_end", *by]

    def passed_by(latest: int | None) -> Column:
        """The watermark, on the clock of the windows; null, which passes nothing, before any time was seen."""
        return plain(F.timestamp_micros(F.lit(latest).cast("long")) - F.expr(f"INTERVAL '{lateness}'"))

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        reached = _before(spark, f"{root}/reached", batch_id)
        latest, timeless = reached.select("latest", "n_timeless").head() if reached is not None else (None, 0)
        counts = f"{root}/counts/_batch_id={batch_id}"
        # Grouping by windows leaves out rows without a time, so they get one and a mark.
        timed = batch.withColumns({"_event_time": event_time, "_timeless": event_time.isNull()})
        timed = timed.withColumn("_event_time", F.coalesce("_event_time", F.timestamp_micros(F.lit(0))))
        counted = (
            timed.groupBy(F.window("_event_time", window).alias("_window"), "_timeless", *map(col, by))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.unix_micros("_event_time")).alias("_latest"))
            .select(start.alias("window_start"), end.alias("window_end"), *map(col, by), "n_rows", "_timeless", "_latest")
            .withColumn("_late", F.coalesce(F.col("window_end") <= passed_by(latest), F.lit(False)))
        )
        counted.write.mode("overwrite").parquet(counts)
        counted = spark.read.schema(counted.schema).parquet(counts)
        newest, without = counted.agg(
            F.max(F.when(~F.col("_timeless"), F.col("_latest"))),
            F.coalesce(F.sum(F.when(F.col("_timeless"), F.col("n_rows"))), F.lit(0)),
        ).head()
        latest = max((t for t in (latest, newest) if t is not None), default=None)
        counted = counted.filter(~F.col("_timeless")).drop("_timeless", "_latest")
        added = counted.filter(~F.col("_late")).drop("_late")
        old = _before(spark, f"{root}/windows", batch_id)
        if old is not None:
            added = added.unionByName(old.filter(F.col("_state") == "open").select(*map(col, keys), "n_rows"))
        state = F.when(F.col("window_end") <= passed_by(latest), "closed").otherwise("open")
        known = added.groupBy(*map(col, keys)).agg(F.sum("n_rows").alias("n_rows")).withColumn("_state", state)
        late = counted.filter("_late").drop("_late").withColumn("_state", F.lit("late"))
        rows = known.unionByName(late)
        rows.write.mode("overwrite").partitionBy("_state").parquet(f"{root}/windows/_batch_id={batch_id}")
        mark = spark.range(1, numPartitions=1).select(
            F.lit(latest).cast("long").alias("latest"),
            F.lit(timeless + without).cast("long").alias("n_timeless"),
        )
        mark.write.mode("overwrite").parquet(f"{root}/reached/_batch_id={batch_id}")  # last: the batch stands

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_closed(spark: SparkSession, root: str) -> DataFrame:
    """The windows that are final, with the micro-batch that closed each."""
    return spark.read.parquet(f"{root}/windows").filter(F.col("_state") == "closed").drop("_state")


def read_open(spark: SparkSession, root: str) -> DataFrame:
    """The windows that may still grow, as the last micro-batch left them."""
    last = spark.read.parquet(f"{root}/reached").agg(F.max("_batch_id")).head()[0]
    rows = spark.read.parquet(f"{root}/windows").filter((F.col("_state") == "open") & (F.col("_batch_id") == last))
    return rows.drop("_state", "_batch_id")


def read_late(spark: SparkSession, root: str) -> DataFrame:
    """How many rows came too late for each window."""
    rows = spark.read.parquet(f"{root}/windows").filter(F.col("_state") == "late")
    keys = [c for c in rows.columns if c not in ("n_rows", "_state", "_batch_id")]
    return rows.groupBy(*map(col, keys)).agg(F.sum("n_rows").alias("n_late"))


def read_timeless(spark: SparkSession, root: str) -> int:
    """How many rows came without a time."""
    return spark.read.parquet(f"{root}/reached").agg(F.max("n_timeless")).head()[0]


def judge_closed_days(
    spark: SparkSession, root: str, limits: Limits = Limits(), by: Sequence[str] = (), final: bool = True, **span: str,
) -> DataFrame:
    """The daily windows of a stream judged as ``volume_by_day`` judges a table.

    A day gets its flag when its window closes, and keeps it: what comes later is late. With ``final`` off, open days are
    judged too, by what they have so far. What is read is a row per day and group.
    """
    days = read_closed(spark, root).drop("_batch_id")
    if not final:
        days = days.unionByName(read_open(spark, root))
    daily = days.select(*map(col, by), F.to_date("window_start").alias("day"), F.col("n_rows").alias("n"))
    return judge_days(daily, limits, by, **span)
