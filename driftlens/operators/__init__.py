"""Relational operators of the engine: registry, snapshots, diff, state, reports."""

from driftlens.operators.detect import detect, detect_union, rule_specs, to_anomaly_rows
from driftlens.operators.diff import diff_status, missing_columns, missing_tables, new_columns, value_change
from driftlens.operators.registry import captured_configs, due_entries, parse_registry
from driftlens.operators.reports import REPORTS, all_reports, report
from driftlens.operators.snapshot import capture, snapshot, unmatched_entries
from driftlens.operators.state import NO_STATE, advance_hwm, current_hwm, hwm_rows
from driftlens.operators.stored import baseline_view, like_join, stored

__all__ = [
    "NO_STATE", "REPORTS", "advance_hwm", "all_reports", "baseline_view", "capture", "captured_configs", "current_hwm",
    "detect", "detect_union", "diff_status", "due_entries", "hwm_rows", "like_join", "missing_columns",
    "missing_tables", "new_columns", "parse_registry", "report", "rule_specs", "snapshot", "stored",
    "to_anomaly_rows", "unmatched_entries", "value_change",
]
