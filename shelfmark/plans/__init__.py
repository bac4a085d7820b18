"""From dataset specs to delivered datasets."""

from .dataset import DatasetSpec, build_dataset, conform_dataset, prepare, union_parts, with_retry
from .ledger import ledger_entries, ledger_state, open_intents, rebuild_ledger, reconcile, resume
from .report import gate_status, publish_gate, refresh_rows, run_summary, written
from .runner import extract, fan_out, group_specs, row_counts, run, run_from_documents

__all__ = [
    "DatasetSpec", "build_dataset", "conform_dataset", "extract", "fan_out", "gate_status",
    "group_specs", "ledger_entries", "ledger_state", "open_intents", "prepare", "publish_gate",
    "rebuild_ledger", "reconcile", "refresh_rows", "resume", "row_counts", "run",
    "run_from_documents", "run_summary", "union_parts", "with_retry", "written",
]
