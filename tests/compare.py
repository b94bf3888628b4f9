"""Compare a Spark result with the rows its SQL counterpart gives in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _kind(value):
    return None if value is None else type(value).__name__


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    return names, Counter(tuple(map(_plain, row)) for row in rows)


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = cursor.fetchall()
    return sorted(names), Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None if both give the same rows with the same kinds of values, else what differs."""
    names, ours = spark_rows(df)
    expected_names, expected = duck_rows(con, sql)
    if names != expected_names:
        return f"columns {names} against {expected_names}"
    if ours != expected:
        return (
            f"{sum(ours.values())} rows against {sum(expected.values())}; "
            f"only ours {list((ours - expected))[:3]}; only expected {list((expected - ours))[:3]}"
        )
    kinds = [{tuple(map(_kind, row)) for row in side} for side in (ours, expected)]
    if kinds[0] != kinds[1]:
        return f"kinds {kinds[0]} against {kinds[1]}"
    return None
