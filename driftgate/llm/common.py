"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of a text, by the definition that all operators share.
WORD = r"[^\x20\x09-\x0D]+"

#: While an intermediate table is written: shuffle files go when it stands, and whole texts cross to Python few at a time.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors see; set to a local one only where unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there, and its shuffles' files may go."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in _WRITING}
    for k, v in _WRITING.items():
        spark.conf.set(k, v)
    try:
        df.select("*").write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_``, ``name__`` … that is no column of ``df`` in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(df: DataFrame, name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return df[f"`{name}`"]


def text_bytes(name: str = "text") -> Column:
    """The whole text as UTF-8 bytes, null as none: Python then need not decode it."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def slices(items: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of ``items`` of up to ``most`` bytes each, or of one longer item."""
    start, held = 0, 0
    for i, x in enumerate(items):
        if held and held + len(x) > most:
            yield start, i
            start, held = i, 0
        held += len(x)
    if start < len(items):
        yield start, len(items)


def lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of ``wanted`` stands in the sorted ``keys``, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted
