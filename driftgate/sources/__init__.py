"""Where batches, contracts and logs come from and go to."""

from driftgate.sources.contracts import (
    CONTRACTS,
    Contract,
    ContractVersion,
    MissingContractError,
    contract_rows,
    contract_versions,
    latest_by,
    latest_snapshots,
    load_contract,
    save_snapshots,
    snapshot_frame,
)
from driftgate.sources.store import RunStore
from driftgate.sources.tables import (
    build_session,
    local_frame,
    read_table,
    tables_with_prefix,
    workspace,
    write_baseline,
)

__all__ = [
    "CONTRACTS",
    "Contract",
    "ContractVersion",
    "MissingContractError",
    "RunStore",
    "build_session",
    "contract_rows",
    "contract_versions",
    "latest_by",
    "latest_snapshots",
    "load_contract",
    "local_frame",
    "read_table",
    "save_snapshots",
    "snapshot_frame",
    "tables_with_prefix",
    "workspace",
    "write_baseline",
]
