"""Schema-drift guard for Spark: contracts, detection, repair, quarantine and audit."""

from driftgate.operators import detect, heal
from driftgate.plans import RunResult, run_batch, run_drill
from driftgate.settings import Limits, profile
from driftgate.sources import CONTRACTS, Contract, RunStore, build_session, load_contract
from driftgate.streaming import gate

__all__ = [
    "CONTRACTS",
    "Contract",
    "Limits",
    "RunResult",
    "RunStore",
    "build_session",
    "detect",
    "gate",
    "heal",
    "load_contract",
    "profile",
    "run_batch",
    "run_drill",
]
