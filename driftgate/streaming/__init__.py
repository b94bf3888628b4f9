"""The row split and the volume count over streams."""

from driftgate.streaming.files import gate_files, read_arrived
from driftgate.streaming.gate import (
    gate,
    read_gate,
    read_gate_actions,
    read_gate_anomalies,
    read_gate_log,
)
from driftgate.streaming.volume import (
    close_windows,
    count_windows,
    judge_closed_days,
    read_closed,
    read_late,
    read_open,
    read_timeless,
    read_windows,
)

__all__ = [
    "close_windows",
    "count_windows",
    "gate",
    "gate_files",
    "judge_closed_days",
    "read_arrived",
    "read_closed",
    "read_gate",
    "read_gate_actions",
    "read_gate_anomalies",
    "read_gate_log",
    "read_late",
    "read_open",
    "read_timeless",
    "read_windows",
]
