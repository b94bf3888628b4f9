"""Schema contracts and their versioned snapshots."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftgate.functions.columns import quoted
from driftgate.functions.text import type_name
from driftgate.sources.tables import local_frame


# What DDL calls types beside the names of Spark's schema JSON.
_DDL_NAMES = {
    "bigint": "long", "dec": "decimal", "int": "integer", "numeric": "decimal", "real": "float", "smallint": "short",
    "timestamp_ltz": "timestamp", "tinyint": "byte",
}


@dataclass(frozen=True)
class Contract:
    """The schema a dataset is expected to have, and which columns it cannot do without."""

    entity: str
    schema: T.StructType
    critical: frozenset[str]
    key: tuple[str, ...]

    @classmethod
    def of(
        cls, entity: str, columns: str | T.StructType, critical: Iterable[str], key: Iterable[str]
    ) -> "Contract":
        """A contract from a schema, or from ``name type`` pairs; a type followed by ``?`` may be null.

        Pairs need no session and state simple types, by any name that DDL has for them, decimals included; nested ones
        take a schema, such as ``StructType.fromDDL`` reads. Columns of pairs may not be null unless marked; ``NOT NULL``
        may be written all the same.
        """
        schema = columns
        if isinstance(columns, str):
            schema = T.StructType()
            for entry in re.split(r",(?![^(]*\))", columns):  # not at the comma of a decimal
                name, kind = entry.split(maxsplit=1)
                kind = re.sub(r"(?i)\s+not\s+null$", "", kind.strip())
                plain = kind.rstrip("?").replace(" ", "").lower()
                base, bracket, rest = plain.partition("(")
                schema = schema.add(name, _DDL_NAMES.get(base, base) + bracket + rest, kind.endswith("?"))
        return cls(entity, schema, frozenset(critical), tuple(key))

    def types(self) -> dict[str, T.DataType]:
        """Expected type by column; names starting with ``_`` are metadata, not contract."""
        return {f.name: f.dataType for f in self.schema.fields if not f.name.startswith("_")}


class MissingContractError(RuntimeError):
    """No snapshot has been saved for the entity."""


# Expected schemas and critical fields of the three entities.
CONTRACTS = {
    c.entity: c
    for c in (
        Contract.of(
            "customers",
            """customer_id string, first_name string, last_name string, email string, phone string?,
            date_of_birth date, address_line1 string, city string, country string,
            kyc_status string, risk_rating string, onboarded_date date""",
            critical=("customer_id", "email", "kyc_status", "risk_rating"),
            key=("customer_id",),
        ),
        Contract.of(
            "accounts",
            """account_id string, customer_id string, account_type string, balance double,
            currency string, status string, opened_date date, branch_code string?,
            last_activity_date timestamp?""",
            critical=("account_id", "customer_id", "account_type", "balance", "status"),
            key=("account_id",),
        ),
        Contract.of(
            "transactions",
            """transaction_id string, account_id string, customer_id string,
            transaction_type string, amount double, currency string, transaction_date timestamp,
            merchant_name string?, merchant_category string?, channel string, status string,
            fraud_flag boolean""",
            critical=("transaction_id", "account_id", "customer_id", "amount",
                      "transaction_type", "transaction_date"),
            key=("transaction_id",),
        ),
    )
}

# Fixed values, but for the last two: the columns of a snapshot.
SNAPSHOT_COLUMNS = (
    "entity_name", "schema_json", "snapshot_timestamp", "version", "critical_json", "key_json",
)


def snapshot_frame(
    spark: SparkSession, contracts: Iterable[Contract], as_of: str, version: str = "1.0"
) -> DataFrame:
    """One snapshot row per contract."""
    rows = [
        (c.entity, c.schema.json(), as_of, version, json.dumps(sorted(c.critical)), json.dumps(c.key))
        for c in contracts
    ]
    return local_frame(spark, dict.fromkeys(SNAPSHOT_COLUMNS, "string"), rows)


def save_snapshots(snapshots: DataFrame, path: str) -> None:
    """Append snapshots, keeping earlier versions."""
    snapshots.write.mode("append").parquet(path)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row of each key that comes last in ``order``, names or expressions.

    An aggregate rather than a ranked window: each task first reduces its own rows to one
    per key, so a key that holds much of the table never lands in one task.
    """
    ranks = [by if isinstance(by, Column) else quoted(by) for by in order]
    last = F.max_by(F.struct(*map(quoted, df.columns)), F.struct(*ranks))
    return df.groupBy(*map(quoted, keys)).agg(last.alias("_last")).select("_last.*")


def version_rank(version: Column) -> Column:
    """A version such as ``10.0`` as its numbers, which order it after ``9.0``."""
    return F.transform(F.split(version, "[.]"), lambda part: part.try_cast("bigint"))


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """The snapshot in force of each entity: the newest, and within a second the highest version."""
    order = ["snapshot_timestamp", version_rank(F.col("version")), "version"]
    return latest_by(snapshots, ["entity_name"], order)


def _restored(row: Row, registry: Mapping[str, Contract]) -> Contract:
    """The contract of a snapshot; one from before critical fields and keys were saved takes them from the registry."""
    entity = row["entity_name"]
    schema = T.StructType.fromJson(json.loads(row["schema_json"]))
    if "critical_json" in row and row["critical_json"] is not None:
        critical, key = json.loads(row["critical_json"]), json.loads(row["key_json"])
        return Contract(entity, schema, frozenset(critical), tuple(key))
    if entity in registry:
        return replace(registry[entity], schema=schema)
    return Contract(entity, schema, frozenset(), ())


def load_contract(
    snapshots: DataFrame, entity: str, registry: Mapping[str, Contract] = CONTRACTS
) -> Contract:
    """The contract in force: the newest snapshot.

    One from before critical fields and keys were saved takes them from the registry.
    """
    newest = latest_snapshots(snapshots.filter(F.col("entity_name") == entity)).first()
    if newest is None:
        raise MissingContractError(f"no schema snapshot saved for {entity!r}")
    return _restored(newest, registry)


@dataclass(frozen=True)
class ContractVersion:
    """A contract and the time from which it is in force, until the next one's."""

    contract: Contract
    since: str
    version: str


def contract_versions(
    snapshots: DataFrame, entity: str, registry: Mapping[str, Contract] = CONTRACTS
) -> list[ContractVersion]:
    """Every version of an entity's contract in the order they came into force.

    Of snapshots of one second the highest version counts, and a snapshot that repeats the one before it is left out. The
    driver gets one row per time that an entity's contract was saved.
    """
    own = snapshots.filter(F.col("entity_name") == entity)
    order = [version_rank(F.col("version")), "version"]
    saved = latest_by(own, ["snapshot_timestamp"], order).orderBy("snapshot_timestamp").collect()
    versions: list[ContractVersion] = []
    for row in saved:
        found = ContractVersion(_restored(row, registry), row["snapshot_timestamp"], row["version"])
        if not versions or (versions[-1].contract, versions[-1].version) != (found.contract, found.version):
            versions.append(found)
    return versions


def contract_rows(spark: SparkSession, contracts: Iterable[Contract]) -> DataFrame:
    """Contracts as rows, one per expected column."""
    rows = [
        (c.entity, name, type_name(data_type), name in c.critical)
        for c in contracts
        for name, data_type in c.types().items()
    ]
    columns = {
        "entity": "string", "field": "string", "expected_type": "string", "critical": "boolean",
    }
    return local_frame(spark, columns, rows)
