"""Sessions, table reads and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.functions.columns import zipped


def build_session(app: str = "driftgate", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine is tuned for; ``conf`` adds or overrides."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # A split write keeps one open file per disposition, so tasks need not sort their rows.
        "spark.sql.maxConcurrentOutputFileWriters": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new folder for written tables, under the folder all executors share.

    A cluster names that folder in ``spark.checkpoint.dir``; only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="driftgate-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a Parquet dataset by path."""
    if "/" in name:
        return spark.read.parquet(name)
    return spark.table(name)


def write_baseline(df: DataFrame, path: str) -> None:
    """Replace a baseline dataset."""
    df.write.mode("overwrite").parquet(path)


def tables_with_prefix(spark: SparkSession, prefix: str, database: str, n: int = 10) -> DataFrame:
    """The last ``n`` catalog tables by name whose name starts with ``prefix``."""
    listed = spark.sql(f"SHOW TABLES IN {database}")
    return (
        listed.filter(F.col("tableName").startswith(prefix))
        .select("tableName")
        .orderBy(F.desc("tableName"))
        .limit(n)
    )


def local_frame(spark: SparkSession, columns: dict[str, str], rows) -> DataFrame:
    """A few rows of parameters as a DataFrame of one partition; ``columns`` gives their types.

    ``createDataFrame`` would spread them over as many tasks as the cluster has cores.
    """
    types = ", ".join(f"{name}: {kind}" for name, kind in columns.items())
    values = dict(zip(columns, zip(*rows, strict=True), strict=True))
    array = zipped(**values).cast(f"array<struct<{types}>>")
    return spark.range(1, numPartitions=1).select(F.inline(array))
