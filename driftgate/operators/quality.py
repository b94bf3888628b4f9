"""Checks on the values of a batch: nulls, domains, ranges and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from driftgate.functions.columns import col, quoted, zipped
from driftgate.settings import AMOUNT_BANDS, HOUR_WEIGHTS, Limits
from driftgate.sources.contracts import Contract
from driftgate.sources.tables import local_frame

_OTHER = "(other)"


def _rate(hits: Column, rows: Column) -> Column:
    return F.when(rows > 0, hits / rows).otherwise(F.lit(0.0))


def _expected(at: str, shares: Sequence[float]) -> Column:
    known = F.element_at(F.array(*map(F.lit, shares)), F.col(at) + 1)
    return F.when(F.col(at).isNull(), F.lit(0.0)).otherwise(known)


def null_profile(
    df: DataFrame, contract: Contract, limits: Limits | Mapping[str, Limits] = Limits()
) -> DataFrame:
    """Rates of nulls and empty strings by column and of rows without any content.

    One aggregate counts everything. A row is without content if every column outside
    the key is null; that rate has the field ``*``. Given several limits by name, the same
    counts are judged by each, with the name in ``profile``.
    """
    fields = [f for f in df.schema.fields if not f.name.startswith("_")]
    payload = [f.name for f in fields if f.name not in contract.key]
    checks = []
    for f in fields:
        null_limit = "critical_null_rate" if f.name in contract.critical else "null_rate"
        checks.append((f.name, "null", f"{quoted(f.name)} IS NULL", null_limit))
        if isinstance(f.dataType, T.StringType):
            checks.append((f.name, "empty", f"trim({quoted(f.name)}) = ''", "empty_rate"))
    if payload:
        nothing = f"coalesce({', '.join(f'{quoted(n)} IS NOT NULL OR NULL' for n in payload)}) IS NULL"
        checks.append(("*", "all_null", nothing, "all_null_rate"))
    # As text, a check is one call to the JVM; as Columns, hundreds of fields take seconds to state.
    counted = df.selectExpr(
        "count(1) AS rows",
        *[f"count(CASE WHEN {test} THEN 1 END) AS hits_{i}" for i, (_, _, test, _) in enumerate(checks)],
    )
    named = limits if isinstance(limits, Mapping) else {"": limits}
    judged = [(profile, i) for profile in named for i in range(len(checks))]
    rates = counted.select(
        F.col("rows").alias("n_rows"),
        F.inline(
            zipped(
                profile=[profile for profile, _ in judged],
                field=[checks[i][0] for _, i in judged],
                metric=[checks[i][1] for _, i in judged],
                max_rate=[float(getattr(named[profile], checks[i][3])) for profile, i in judged],
                n_hits=[F.col(f"hits_{i}") for _, i in judged],
            )
        ),
    ).withColumn("rate", _rate(F.col("n_hits"), F.col("n_rows")))
    names = ["profile"] if isinstance(limits, Mapping) else []
    return rates.select(
        *names, "field", "metric", "n_rows", "n_hits", "rate", "max_rate",
        (F.col("rate") > F.col("max_rate")).alias("flagged"),
    )


def null_spikes(df: DataFrame, ts: str, limits: Limits = Limits()) -> DataFrame:
    """Null rate by day and column; a day at or above the spike rate is flagged."""
    names = [n for n in df.columns if n != ts and not n.startswith("_")]
    daily = df.groupBy(F.to_date(col(ts)).alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.expr(f"count_if({quoted(n)} IS NULL)").alias(f"nulls_{i}") for i, n in enumerate(names)],
    )
    nulls = zipped(field=names, n_nulls=[F.col(f"nulls_{i}") for i in range(len(names))])
    rate = _rate(F.col("n_nulls"), F.col("n_rows"))
    return daily.select("day", "n_rows", F.inline(nulls)).select(
        "day", "field", "n_rows", "n_nulls", rate.alias("rate"),
        (rate >= limits.null_spike_rate).alias("spike"),
    )


def domain_violations(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the allowed ones, with how often each occurs; nulls are not values."""
    outside = df.filter(col(column).isNotNull() & ~col(column).isin(*allowed))
    return outside.groupBy(col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


def domain_share(df: DataFrame, column: str, weights: Mapping[str, float]) -> DataFrame:
    """Observed share of each allowed value beside its expected share.

    Values outside the domain count as one, so the table stays as short as the domain;
    nulls have a row of their own.
    """
    total = float(sum(weights.values()))
    shares = [(v, float(w) / total) for v, w in weights.items()] + [(_OTHER, 0.0), (None, 0.0)]
    expected = local_frame(df.sparkSession, {"value": "string", "expected_share": "double"}, shares)
    known = col(column).isNull() | col(column).isin(*weights)
    bucket = F.when(known, col(column)).otherwise(F.lit(_OTHER))
    counted = df.groupBy(bucket.alias("seen")).agg(F.count(F.lit(1)).alias("n"))
    n_rows = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    # One row per domain value reaches the window.
    everything = F.sum(n_rows).over(Window.partitionBy())
    # At most one row per domain value, one for the others and one for nulls.
    return expected.join(F.broadcast(counted), F.col("value").eqNullSafe(F.col("seen")), "left").select(
        "value",
        n_rows.alias("n_rows"),
        _rate(n_rows, everything).alias("share"),
        "expected_share",
    )


def range_violations(
    df: DataFrame, category: str, value: str, bounds: Mapping[str, tuple[float, float]] | DataFrame
) -> DataFrame:
    """Rows whose value lies outside the bounds of their category, with those bounds.

    ``reason`` is ``out_of_range``, or ``unknown_category`` for rows whose category is null or has
    no bounds. A null value is in no range and not reported by itself. ``bounds`` maps a category to its lowest and highest value, or is a DataFrame of
    ``category``, ``low`` and ``high`` with one row per category.
    """
    if isinstance(bounds, DataFrame):
        limits = bounds.select(F.col("category").alias("_category"), "low", "high")
    else:
        # Parameters of the call; a handful.
        columns = {"_category": "string", "low": "double", "high": "double"}
        rows = [(name, *lowest_highest) for name, lowest_highest in bounds.items()]
        limits = F.broadcast(local_frame(df.sparkSession, columns, rows))
    matched = df.join(limits, col(category) == F.col("_category"), "left")
    outside = ~col(value).between(F.col("low"), F.col("high"))
    reason = F.when(F.col("_category").isNull(), "unknown_category").when(outside, "out_of_range")
    return matched.withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("_category")


def amount_bands(
    df: DataFrame, value: str, bands: Sequence[tuple[float, float]] = AMOUNT_BANDS
) -> DataFrame:
    """Rows by amount band, with the share expected of each.

    ``bands`` lists the upper edge of each band, exclusive, and its expected percentage;
    amounts from the last edge up form a band of their own, and nulls a null band.
    """
    label = F.when(col(value).isNull(), F.lit(None).cast("int"))
    for i, (edge, _) in enumerate(bands):
        label = label.when(col(value) < edge, F.lit(i))
    label = label.otherwise(F.lit(len(bands)))
    counted = df.groupBy(label.alias("band")).agg(F.count(F.lit(1)).alias("n_rows"))
    expected = [percent / 100.0 for _, percent in bands] + [0.0]
    return counted.select(
        "band",
        "n_rows",
        (F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy())).alias("share"),
        _expected("band", expected).alias("expected_share"),
    )


def hour_profile(df: DataFrame, ts: str, weights: Sequence[float] = HOUR_WEIGHTS) -> DataFrame:
    """Rows by hour of the day, with the share expected of each hour; rows without a time under a null hour."""
    total = float(sum(weights))
    counted = df.groupBy(F.hour(col(ts)).alias("hour")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(
        "hour",
        "n_rows",
        (F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy())).alias("share"),
        _expected("hour", [w / total for w in weights]).alias("expected_share"),
    )
