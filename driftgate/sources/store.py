"""The datasets a run leaves behind.

    <root>/baselines/<entity>/                    good data, for drills
    <root>/contracts/                             schema snapshots, every version
    <root>/drifted/_entity=E/_run_id=R/           the batch as it arrived
    <root>/batches/_entity=E/_run_id=R/_disposition=clean/       repaired rows
    <root>/batches/_entity=E/_run_id=R/_disposition=quarantine/  rows held back, with reasons
    <root>/logs/<name>/_entity=E/run_id=R/        log rows of the run
    <root>/archive/<name>/_day=D/                 the same rows by the day of their time, for reading the newest

Every write of a run replaces the folder of its own entity and run as a whole, so repeating a run
changes nothing and leaves no rows of the earlier attempt behind. An orchestrator may give one run id
to several entities: nothing they write shares a folder, and no run has to look at earlier ones.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from driftgate.sources.contracts import (
    CONTRACTS,
    SNAPSHOT_COLUMNS,
    Contract,
    MissingContractError,
    load_contract,
    save_snapshots,
    snapshot_frame,
)
from driftgate.sources.tables import write_baseline

CLEAN = "clean"
QUARANTINE = "quarantine"
# The values of cast columns as they arrived, in rows held back.
ARRIVED = "_arrived"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

# Columns of the logs.
_ANOMALY = (
    "anomaly_id STRING, run_id STRING, anomaly_type STRING, severity STRING, entity STRING, "
    "field STRING, detected_at STRING, details STRING, action STRING"
)
_SUMMARY = (
    "run_id STRING, entity STRING, drift_type STRING, force_critical BOOLEAN, anomaly_count BIGINT, "
    "max_severity STRING, rows_quarantined BIGINT, rows_surviving BIGINT, summary_text STRING, "
    "completed_at STRING"
)
# The time of a row, by log; the archive is kept by its day.
LOG_TIMES = {
    "anomaly_log": "detected_at", "action_log": "detected_at", "run_summaries": "completed_at", "pipeline_log": "completed_at",
}
LOG_SCHEMAS = {
    "anomaly_log": _ANOMALY,
    "action_log": f"{_ANOMALY}, applied_action STRING, rows_affected BIGINT, result_path STRING",
    "run_summaries": _SUMMARY,
    "pipeline_log": f"{_SUMMARY}, drifted_path STRING",
}


def _readable(read: Callable[[], DataFrame]) -> bool:
    """Whether a dataset is there; planning the read is enough to find out."""
    try:
        read()
    except AnalysisException:
        return False
    return True


def _partition_values(path: str) -> dict[str, str]:
    """The partition columns that the path of a file names."""
    return dict(part.split("=", 1) for part in path.split("/") if "=" in part)


class RunStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        # With one open file at a time, Spark would sort every batch by disposition.
        if int(spark.conf.get(_WRITERS)) < 2:
            spark.conf.set(_WRITERS, "4")
        self.root = root.rstrip("/")

    def run_path(self, kind: str, entity: str, run_id: str) -> str:
        return f"{self._entity_path(kind, entity)}/_run_id={run_id}"

    def _entity_path(self, kind: str, entity: str) -> str:
        # Spark reads such a name back as it was: it knows escapes of single bytes only.
        name = re.sub(r"[\x00-\x7f]", lambda c: c[0] if c[0].isalnum() or c[0] in "_-. " else f"%{ord(c[0]):02X}", entity)
        return f"{self.root}/{kind}/_entity={name}"

    def quarantine_path(self, entity: str, run_id: str) -> str:
        return f"{self.run_path('batches', entity, run_id)}/_disposition={QUARANTINE}"

    def entities_of(self, run_id: str, kind: str = "batches") -> list[str]:
        """The entities that have a run of this id."""
        read = self.spark.read.schema("_entity STRING").option("basePath", f"{self.root}/{kind}")
        try:
            files = read.parquet(f"{self.root}/{kind}/_entity=*/_run_id={run_id}").inputFiles()
        except AnalysisException:
            return []
        return sorted({unquote(unquote(_partition_values(path)["_entity"])) for path in files})

    def _only_entity(self, run_id: str, kind: str) -> str:
        found = self.entities_of(run_id, kind)
        if len(found) > 1:
            raise ValueError(f"run id {run_id!r} has runs of {found}; name the entity")
        return found[0] if found else ""

    # -- baselines and contracts -----------------------------------------

    def prepare(
        self, baselines: Mapping[str, DataFrame], contracts: Iterable[Contract], as_of: str,
        version: str = "1.0",
    ) -> None:
        """Replace the baselines and add a snapshot of the contracts."""
        for entity, df in baselines.items():
            write_baseline(df, f"{self.root}/baselines/{entity}")
        save_snapshots(snapshot_frame(self.spark, contracts, as_of, version), f"{self.root}/contracts")

    def baseline(self, entity: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/baselines/{entity}")

    def contract(self, entity: str, registry: Mapping[str, Contract] = CONTRACTS) -> Contract:
        """The contract in force for an entity; fails if none was ever saved."""
        try:
            stored = self.spark.read.schema(", ".join(f"{c} STRING" for c in SNAPSHOT_COLUMNS))
            snapshots = stored.parquet(f"{self.root}/contracts")
        except AnalysisException as missing:
            raise MissingContractError(f"no schema snapshot saved for {entity!r}") from missing
        return load_contract(snapshots, entity, registry)

    # -- batches -----------------------------------------------------------

    def write_drifted(self, df: DataFrame, entity: str, run_id: str) -> str:
        path = self.run_path("drifted", entity, run_id)
        df.drop("_run_id").write.mode("overwrite").parquet(path)
        return path

    def drifted(self, run_id: str, entity: str | None = None) -> DataFrame:
        """The batch of a run as it arrived, with its id."""
        return self._read("drifted", run_id, entity)

    def write_split(self, healed, run_id: str) -> dict[str, int]:
        """Write clean and quarantined rows in one pass; return the counts seen on the way.

        The counts are taken in the writing stage itself, so the batch is not read again.
        """
        seen = Observation()
        path = self.run_path("batches", healed.contract.entity, run_id)
        rows = healed.stored(seen).drop("_run_id")
        rows.write.mode("overwrite").partitionBy("_disposition").parquet(path)
        return seen.get

    def _read(self, kind: str, run_id: str, entity: str | None, part: str = "") -> DataFrame:
        """What a run stored; fails if there is nothing. Without an entity, of the only one with a run of this id."""
        entity = entity or self._only_entity(run_id, kind)
        read = self.spark.read.option("basePath", self._entity_path(kind, entity))
        return read.parquet(self.run_path(kind, entity, run_id) + part)

    def _stored(self, run_id: str, entity: str | None, disposition: str | None = None) -> DataFrame:
        """What a run's split stored, or of that one disposition; fails if there is nothing."""
        return self._read("batches", run_id, entity, f"/_disposition={disposition}" if disposition else "")

    def _batch(self, run_id: str, entity: str | None, disposition: str) -> DataFrame:
        """The rows of one disposition; empty, with the columns of the other, if the run has none."""
        entity = entity or self._only_entity(run_id, "batches")
        try:
            rows = self._stored(run_id, entity, disposition)
        except AnalysisException:
            rows = self._stored(run_id, entity).filter(F.col("_disposition") == disposition)
        return rows.drop("_disposition")

    def clean(self, run_id: str, entity: str | None = None) -> DataFrame:
        """Clean rows of a run, with its id; none if all were held back."""
        reasons = ("_quarantine_reason", "_quarantine_reasons", ARRIVED)
        return self._batch(run_id, entity, CLEAN).drop(*reasons)

    def quarantine(self, run_id: str, entity: str | None = None) -> DataFrame:
        """Quarantined rows of a run as they arrived, with their reasons; none if all were clean."""
        rows = self._batch(run_id, entity, QUARANTINE)
        if ARRIVED not in rows.columns:
            return rows
        names = rows.schema[ARRIVED].dataType.names
        return rows.withColumns({name: F.col(ARRIVED)[name] for name in names}).drop(ARRIVED)

    def quarantined_runs(self, n: int) -> list[str]:
        """The last ``n`` run ids that hold quarantined rows, logged or not.

        A partition is there only if it has rows, so the list of partitions is enough and no file is opened.
        """
        held = self.partitions().filter(F.col("_disposition") == QUARANTINE)
        return [r["_run_id"] for r in held.select("_run_id").distinct().orderBy(F.desc("_run_id")).limit(n).collect()]

    def partitions(self) -> DataFrame:
        """What is stored, a row for each entity, run and disposition, by the catalog's list of partitions.

        The stored batches are an external table of the session catalog, which Spark brings up to date with the folders, in
        parallel where there are many; the driver sees partitions, not files.
        """
        path = f"{self.root}/batches"
        name = f"driftgate_batches_{hashlib.md5(path.encode()).hexdigest()}"
        columns = "_entity STRING, _run_id STRING, _disposition STRING"
        if not _readable(lambda: self.spark.read.schema(columns).parquet(path)):
            return self.spark.createDataFrame([], columns)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (_quarantine_reason STRING, {columns}) USING parquet "
            f"PARTITIONED BY (_entity, _run_id, _disposition) LOCATION '{place}'"
        )
        self.spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        listed = self.spark.sql(f"SHOW PARTITIONS {name}")
        values = [F.split_part(F.split_part("partition", F.lit("/"), F.lit(i)), F.lit("="), F.lit(2)) for i in (1, 2, 3)]
        # Names are escaped as in paths, which leave a plus as it is.
        return listed.select(*[
            F.url_decode(F.replace(v, F.lit("+"), F.lit("%2B"))).alias(c)
            for v, c in zip(values, ("_entity", "_run_id", "_disposition"), strict=True)
        ])

    def compact(self, run_id: str, entity: str | None = None, disposition: str = QUARANTINE, file_bytes: int = 128 << 20) -> int:
        """Put the many small files of a run's part together into files of about ``file_bytes``; returns how many files it
        has then, 0 if there is no such part.

        Spark writes beside the folder and swaps it in when all is written, so a job that breaks off changes nothing. Rows
        are not shuffled.
        """
        path = self.run_path("batches", entity or self._only_entity(run_id, "batches"), run_id)
        try:
            rows = self.spark.read.option("basePath", path).parquet(f"{path}/_disposition={disposition}")
        except AnalysisException:
            return 0
        files = self.spark.read.format("binaryFile").load(f"{path}/_disposition={disposition}")
        total, count = files.agg(F.sum("length"), F.count("*")).first()
        wanted = max(1, -(-total // file_bytes))
        if count > wanted:
            write = rows.coalesce(wanted).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            write.partitionBy("_disposition").parquet(path)
        return min(count, wanted)

    def _layout(self) -> DataFrame:
        """The stored batches as entities, run ids and dispositions alone."""
        return self.spark.read.schema("_entity STRING, _run_id STRING, _disposition STRING").parquet(f"{self.root}/batches")

    def register_run(self, run_id: str, entity: str | None = None) -> list[str]:
        """Make the batches of a run queryable in SQL as temporary views, those that hold rows; returns their names.

        With an entity given, the names hold it too, so that runs of one id can be seen side by side.
        """
        owner = f"{re.sub('[^A-Za-z0-9_]', '_', entity)}_" if entity else ""
        parts = {
            f"drifted_{owner}{run_id}": (self.drifted, lambda: self.drifted(run_id, entity)),
            f"clean_{owner}{run_id}": (self.clean, lambda: self._stored(run_id, entity, CLEAN)),
            f"quarantine_{owner}{run_id}": (self.quarantine, lambda: self._stored(run_id, entity, QUARANTINE)),
        }
        made = [name for name, (_, stored) in parts.items() if _readable(stored)]
        for name in made:
            parts[name][0](run_id, entity).createOrReplaceTempView(name)
        return made

    def quarantine_counts(self, run_ids: Sequence[str] | None = None) -> DataFrame:
        """Quarantined rows by run and entity, of the given runs or of all.

        Only the partitions asked for are visited, and of their files only the footers.
        """
        held = self._layout()
        if run_ids is not None:
            held = held.filter(F.col("_run_id").isin(*run_ids))
        return (
            held.filter(F.col("_disposition") == QUARANTINE)
            .groupBy(F.col("_run_id").alias("run_id"), F.col("_entity").alias("entity"))
            .agg(F.count("*").alias("n_rows"))
        )

    # -- logs --------------------------------------------------------------

    def append_log(self, name: str, rows: DataFrame, run_id: str, entity: str = "") -> None:
        """Add the log rows of one run. Later runs may bring more columns."""
        own = rows.drop("run_id").coalesce(1)
        own.write.mode("overwrite").parquet(f"{self._entity_path(f'logs/{name}', entity or '-')}/run_id={run_id}")

    def empty_log(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], LOG_SCHEMAS[name])

    def log(self, name: str, evolved: bool = False) -> DataFrame:
        """All rows of a log.

        The engine's own logs are read with their known columns, without opening any file.
        With ``evolved``, and for other logs, the columns of every run are merged, null
        where a run had none.
        """
        path = f"{self.root}/logs/{name}"
        if name in LOG_SCHEMAS and not evolved:
            schema = f"{LOG_SCHEMAS[name]}, _entity STRING"
            return self.spark.read.schema(schema).parquet(path).drop("_entity")
        rows = self.spark.read.option("mergeSchema", "true").parquet(path).drop("_entity")
        return rows.select("run_id", *[c for c in rows.columns if c != "run_id"])

    def has_log(self, name: str) -> bool:
        return _readable(lambda: self.log(name))

    def archive_log(self, name: str, since: str | None = None, until: str | None = None, rows: DataFrame | None = None) -> None:
        """Keep the rows of a log by day, a few files a day instead of one a run.

        Days from ``since`` to ``until`` (``YYYY-MM-DD``, both included) are replaced as they now stand in the log; without
        ``since`` and ``until`` the whole archive is. Other log rows may be given instead of the store's own.
        """
        day = F.left(F.col(LOG_TIMES[name]), F.lit(10))
        rows = (self.log(name) if rows is None else rows).withColumn("_day", day)
        some = [t for t in ((day >= since) if since else None, (day <= until) if until else None) if t is not None]
        for test in some:
            rows = rows.filter(test)
        # Tasks of adaptive size: a busy day may get several files, a quiet one gets one.
        write = rows.hint("rebalance", "_day").write.mode("overwrite").partitionBy("_day")
        write.option("partitionOverwriteMode", "dynamic" if some else "static").parquet(f"{self.root}/archive/{name}")

    def archived(self, name: str) -> DataFrame:
        """All archived rows of a log, with their ``_day``, which prunes the days that are read."""
        path = f"{self.root}/archive/{name}"
        try:
            return self.spark.read.schema(f"{LOG_SCHEMAS[name]}, _day STRING").parquet(path)
        except AnalysisException:
            return self.empty_log(name).withColumn("_day", F.lit(None).cast("string"))

    def newest(self, name: str, n: int) -> DataFrame:
        """The rows of the newest archived days that hold ``n`` rows together, all rows if there are fewer.

        Whatever the archive's size, only those days' files are opened: of 1, 2, 4, … days the rows are counted, by the
        files' footers, until there are enough. The driver sees the names of the days.
        """
        rows = self.archived(name)
        days = sorted({_partition_values(p)["_day"] for p in rows.inputFiles()}, reverse=True)
        span = 1
        while span < len(days):
            recent = rows.filter(F.col("_day") >= days[span - 1])
            if recent.count() >= n:
                return recent.drop("_day")
            span *= 2
        return rows.drop("_day")

    def register_views(self) -> list[str]:
        """Make the logs queryable in SQL as temporary views; returns their names."""
        made = [n for n in LOG_SCHEMAS if self.has_log(n)]
        for name in made:
            self.log(name).createOrReplaceTempView(name)
        return made
