"""The registered queries: each operator over the supplied tables, with its SQL counterpart."""

from workload.registry import ORACLES, QUERIES

from workload import checks, drift, evolving, logs, runs, streams  # noqa: E402,F401  (register their queries)

__all__ = ["ORACLES", "QUERIES"]
