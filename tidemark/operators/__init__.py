"""DataFrame -> DataFrame operators (identity, rolling diff, sweep, SCD, DQ, projection, audit).

Submodules keep their own names (``tidemark.operators.project`` is the
projection module); only functions whose names differ from a submodule are
re-exported here.
"""

from tidemark.operators.identity import add_identity
from tidemark.operators.quality import gate, quarantine, split
from tidemark.operators.reconcile import check_guards, sweep_due, sweep_metrics, tombstones
from tidemark.operators.rolling import RollingSpec, detect_deletes, read_window, snapshot
from tidemark.operators.scd import change_stream_scd2, lifespan, live_rows, scd1, scd2

__all__ = [
    "add_identity", "gate", "quarantine", "split", "check_guards", "sweep_due", "sweep_metrics",
    "tombstones", "RollingSpec", "detect_deletes", "read_window", "snapshot", "change_stream_scd2",
    "lifespan", "live_rows", "scd1", "scd2",
]
