"""Column references, hashes and run ids."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shape of a run id.
_NOT_ALLOWED = "[^A-Za-z0-9_]"
_RUN_ID_LENGTH = 40
_RUN_ID_PREFIX = "run_"
# Ours: digits of the hash behind an id that was changed.
_MARK_LENGTH = 8


def quoted(name: str) -> str:
    """A column name as SQL text, also when it holds dots or backticks."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Reference a column by its exact name."""
    return F.col(quoted(name))


def apart(df: DataFrame, known: Iterable[str] = ()) -> DataFrame:
    """The same columns with no two names that differ only in case, which Spark cannot tell apart.

    The one spelt as in ``known`` keeps its name, else the first; the others get their position, ``V`` in
    the third place becoming ``V_3``, and so count as columns nobody expects.
    """
    known, names = set(known), df.columns
    if len({name.lower() for name in names}) == len(names):
        return df
    keeps = {}
    for name in sorted(names, key=lambda name: name not in known):  # stable: in order otherwise
        keeps.setdefault(name.lower(), name)
    taken, renamed = {name.lower() for name in names}, []
    for i, name in enumerate(names, 1):
        if keeps.get(name.lower()) == name:
            keeps[name.lower()] = None
        else:
            name = f"{name}_{i}"
            while name.lower() in taken:
                name += "_"
        taken.add(name.lower())
        renamed.append(name)
    return df.toDF(*renamed)


def as_column(value) -> Column:
    """A Column as it is, anything else as a literal."""
    return value if isinstance(value, Column) else F.lit(value)


def count_where(test: Column) -> Column:
    """Aggregate: the rows for which ``test`` is true."""
    return F.count(F.when(test, F.lit(1)))


def zipped(**lists) -> Column:
    """Equally long lists, of values or of Columns, as one array of structs with these names."""
    arrays = []
    for name, items in lists.items():
        items = list(items)
        columns = any(isinstance(item, Column) for item in items)
        arrays.append((F.array(*map(as_column, items)) if columns else F.lit(items)).alias(name))
    return F.arrays_zip(*arrays)


def hash_bucket(key, salt: int) -> Column:
    """Bucket 0..9999 of a key. The same key falls in the same bucket on any partitioning."""
    names = [key] if isinstance(key, (str, Column)) else list(key)
    parts = [(col(n) if isinstance(n, str) else n).cast("string") for n in names]
    digest = F.md5(F.concat(F.concat_ws("|", *parts), F.lit(f":{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10000


def anomaly_id(run_id, entity, anomaly_type, field) -> Column:
    """Stable id of an anomaly: the same finding of the same run keeps its id when re-run."""
    return F.sha2(F.concat_ws("|", *map(as_column, (run_id, entity, anomaly_type, field))), 256)


def sanitize_run_id(raw: Column) -> Column:
    """Column form of :func:`resolve_run_id` for a caller-supplied id."""
    safe = F.regexp_replace(raw, _NOT_ALLOWED, "_")
    whole = (safe == raw) & (F.length(raw) <= _RUN_ID_LENGTH)
    mark = F.concat(F.lit("_"), F.substring(F.md5(raw), 1, _MARK_LENGTH))
    return F.concat(F.lit(_RUN_ID_PREFIX), F.substring(safe, 1, _RUN_ID_LENGTH), F.when(whole, "").otherwise(mark))


def default_run_id(now: datetime) -> str:
    """An id from the clock, to the microsecond where it has any."""
    shape = "%Y%m%d_%H%M%S_%f" if now.microsecond else "%Y%m%d_%H%M%S"
    return now.strftime(_RUN_ID_PREFIX + shape)


def resolve_run_id(raw: str | None, now: datetime) -> str:
    """The run id to use: a caller-supplied one made safe, else one from the clock.

    An id that had to be changed or cut ends in a hash of what was given, so different ids stay different.
    """
    if not raw:
        return default_run_id(now)
    raw = str(raw)
    safe = re.sub(_NOT_ALLOWED, "_", raw)
    whole = safe == raw and len(raw) <= _RUN_ID_LENGTH
    mark = "" if whole else "_" + hashlib.md5(raw.encode()).hexdigest()[:_MARK_LENGTH]
    return _RUN_ID_PREFIX + safe[:_RUN_ID_LENGTH] + mark
